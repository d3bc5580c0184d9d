from conftest import rows
from glossmill.operators import checks, entries, lookup
from glossmill.plans.config import LookupRules
from pyspark.sql import functions as F

import pytest


def _e(title, definition="", details=(), categories=(), aliases=(), pos=None):
    return {"title": title, "definition": definition, "details": list(details), "source_categories": list(categories), "redirect_aliases": list(aliases), "pos": pos}


@pytest.fixture
def found(make):
    def run(items, **rules):
        e = make("entries", [x | {"pos": i} for i, x in enumerate(items)])
        return e, lookup.lookups(e, LookupRules(**rules))

    return run


def _accepted(found):
    return {(r.alias, r.target) for r in found.accepted.collect()}


def _shared(found):
    out = {}
    for r in found.shared.orderBy("ord").collect():
        out.setdefault(r.word, []).append(r.target)
    return out


def test_canonical_collision(found):
    _, f = found([_e("Fireball"), _e("Fireball Spell")])
    assert _shared(f) == {"Fireball": ["Fireball", "Fireball Spell"]} and not _accepted(f)


def test_shared_title_rule_and_suffix(found):
    _, f = found([_e("Heal Pet Potion"), _e("Heal Pet Spell"), _e("1914 Box"), _e("Potion of Bloodlust")])
    assert _shared(f) == {"Heal Pet": ["Heal Pet Potion", "Heal Pet Spell"]}
    assert {("1914", "1914 Box"), ("Bloodlust", "Potion of Bloodlust")} <= _accepted(f)


def test_plurals(found):
    _, f = found([_e("Dirigible Gnome", categories=["Races"]), _e("1914 Box", categories=["Items"]), _e("Borant Corporation", categories=["Groups"]), _e("Bush Elf", categories=["Category:Races"]), _e("Dwarf", categories=["Races"]), _e("Bandages", categories=["Items"]), _e("Gondii", categories=["Races"]), _e("Eye of the Sky Scroll", categories=["Items"])])
    plurals = {a for a, _ in ((r.alias, r.source) for r in f.accepted.where("source = 'category-plural'").collect())}
    assert plurals == {"Dirigible Gnomes", "1914 Boxes", "Borant Corporations", "Bush Elves", "Dwarfs", "Dwarves", "Eye of the Sky Scrolls"}


def test_generic_and_noisy(found):
    _, f = found([_e("System AI", aliases=["system ai", "System AI (old)", "Spell", "", None, "AI [1]", "http://x", '"Q"', "x"])])
    assert {(r.alias, r.reason) for r in f.omitted.collect()} >= {("system ai", "not-title-like"), ("System AI (old)", "parenthetical-note"), ("Spell", "generic-word"), ("", "empty"), ("AI [1]", "citation-marker"), ("http://x", "not-a-name"), ('"Q"', "quoted-noise"), ("x", "too-short")}


def test_intro_parentheticals(found):
    _, f = found([_e("Loot Sacks", "<b>Loot Sacks</b> (or Sacs) are bags."), _e("Borant Corporation", "The <b>Borant Corporation</b> (aka Borant) rules."), _e("Gravy", 'Gravy (actually named "Gravy Boat") floats.'), _e("Grimaldi", '<b>Grimaldi</b> (shortened to “Grim”) broods.')])
    assert {("Sacs", "Loot Sacks"), ("Borant", "Borant Corporation"), ("Gravy Boat", "Gravy"), ("Grim", "Grimaldi"), ("The Borant Corporation", "Borant Corporation")} <= _accepted(f)


def test_sidebar(found):
    _, f = found([_e("Valtay Corporation", "The <b>Valtay Corporation</b> is big.", [("Aliases", "The Valtay, The Brain Worms or VC; Valtay Corp"), ("Origin", "Space")])])
    assert {"The Valtay", "Valtay", "The Brain Worms", "Brain Worms", "VC", "Valtay Corp"} <= {a for a, _ in _accepted(f)}
    _, f = found([_e("One", details=[("Aliases", "Both")]), _e("Two", details=[("Aliases", "Both")])])
    assert {(r.alias, r.reason) for r in f.omitted.collect()} == {("Both", "alias-collision")}


def test_names(found):
    _, f = found([_e("Aegon Frey", categories=["Characters"]), _e("Aegon Targaryen", categories=["Characters"])])
    assert _shared(f) == {w: ["Aegon Frey", "Aegon Targaryen"] for w in ("Aegon", "Aegon's", "Aegon’s")}
    _, f = found([_e("Katia Grim", details=[("Race", "Human")]), _e("Carl"), _e("Carl Smith", details=[("Race", "human")])])
    assert {("Katia", "Katia Grim"), ("Grim", "Katia Grim"), ("Smith", "Carl Smith")} <= _accepted(f)
    assert _shared(f) == {"Carl": ["Carl", "Carl Smith"]}


def test_components(found):
    _, f = found([_e("Alpha Beta"), _e("Alpha Gamma")], ignore_words=("Unused",))
    assert ("Beta", "Alpha Beta") in _accepted(f)
    _, f = found([_e("Silver Hammer")], ignore_words=("Box",))
    assert ("Silver", "Silver Hammer") in _accepted(f)
    _, f = found([_e("Alpha Beta Gamma Box")], ignore_words=("Box",))
    assert "title-component" not in {r.source for r in f.accepted.collect()}


def test_counts_and_terms(found, spark):
    items = [_e("Valtay Corporation"), _e("Desperado Club"), _e("Earth"), _e("Earth Box")]
    e, f = found(items, suffixes=(" Box",), prefixes=(), ignore_words=("Corporation", "Club", "Box"))
    assert _shared(f) == {"Earth": ["Earth", "Earth Box"]}
    assert rows(lookup.format_health(e, f)) == [("Kindle", 4, 5), ("Kobo", 4, 4), ("StarDict", 4, 4)]
    c = lookup.counts(e, f).first()
    assert (c.n_entries, c.n_accepted, c.n_shared) == (4, 2, 1)
    terms = spark.createDataFrame([("valtay",), ("EARTH",), ("desperado club",), ("Nope",)], "term string")
    assert {r.term: (r.status, r.targets) for r in lookup.term_statuses(terms, e, f).collect()} == {"valtay": ("alias", "Valtay Corporation"), "EARTH": ("multi-target", "Earth|Earth Box"), "desperado club": ("canonical", "Desperado Club"), "Nope": ("missing", "")}
    forms = {(r.target, r.ord): r.form for r in lookup.alias_forms(e, f).collect()}
    assert forms["Valtay Corporation", 0] == "Valtay Corporation" and forms["Valtay Corporation", 1] == "Valtay"


def test_quality(found):
    many = [_e(f"Entry {chr(65 + i)}{chr(65 + i)}", aliases=["Shared"]) for i in range(9)]
    _, f = found([_e("Nebs", details=[("Aliases", "NebsNebular")]), *many])
    assert {(r.kind, r.alias) for r in lookup.quality_findings(f).collect()} == {("possibly-joined-sidebar-alias", "NebsNebular"), ("broad-multi-target-lookup", "Shared")}
    assert lookup.debug_lines(f).count() == 2


def test_nulls_duplicates_and_empty(make):
    e = make("entries", [{"pos": 1, "title": "A Box"}, {"pos": 1, "title": "A Box"}, {"pos": 2, "title": None}, {"pos": 3, "title": ""}]).withColumn("word", F.lit("clash")).withColumn("alias", F.lit(1))
    f = lookup.lookups(e)
    assert rows(f.accepted, "alias", "target") == [] and rows(f.omitted, "alias", "reason") == [("A", "too-short")]
    f = lookup.lookups(make("entries", []))
    assert f.accepted.isEmpty() and f.shared.isEmpty() and f.omitted.isEmpty()


def test_forwarding(make):
    def final(items):
        e = make("entries", [{"pos": i, "title": t} for i, (t, _) in enumerate(items)])
        plain = F.element_at(F.array(*[F.lit(d) for _, d in items]), (F.col("pos") + 1).cast("int"))
        return {(items[r.pos][0], items[r.final][0]) for r in entries.forwarding(e.withColumn("plain", plain)).collect()}

    assert final([("Final", "Final has the answer."), ("Middle", "See: Final"), ("Start", "See: Middle"), ("Far", "please see start.")]) == {("Middle", "Final"), ("Start", "Final"), ("Far", "Final")}
    assert final([("A", "See: B"), ("B", "See: A"), ("C", "See: A"), ("D", "See: Nowhere"), ("E", "See: D"), ("F", "See: F")]) == set()
    chain = [("T0", "The end.")] + [(f"T{i}", f"See: T{i - 1}") for i in range(1, 40)]
    assert len(final(chain)) == 39


def test_assembly(make):
    html = '<aside class="portable-infobox"><div class="pi-data" data-source="aliases"><h3 class="pi-data-label">A</h3><div class="pi-data-value">D</div></div></aside><div class="dcc-highlight">Spoilers ahead</div>'
    p = [
        {"pageid": 1, "title": "Donut", "first_paragraph": "<b>Princess&#160;Donut</b> [1] isa cat , really.", "raw_html": html, "status": "ok", "in_scope": 1, "source_category": "Characters, Category:Groups, characters"},
        {"pageid": 2, "title": "Carl (delver)", "first_paragraph": "Carl is a delver.", "status": "ok", "in_scope": 1},
        {"pageid": 3, "title": "Bad", "first_paragraph": "Something long enough.", "status": "error", "in_scope": 1},
        {"pageid": 4, "title": "Tiny", "first_paragraph": "short", "status": "ok", "in_scope": 1},
        {"pageid": 5, "title": "Old", "first_paragraph": "An old page here.", "status": "ok", "in_scope": 0},
        {"pageid": 6, "title": "Stub", "first_paragraph": "Stub is.", "status": "ok", "in_scope": 1},
        {"pageid": 7, "title": "Cat", "first_paragraph": "See: donut", "status": "ok", "in_scope": 1},
    ]
    r = [{"source_title": s, "target_title": t, "status": k} for s, t, k in (("The Cat", "donut", "ok"), ("GC BWR", "Donut", "ok"), ("No", "Donut", "ignored"), (None, "Donut", "ok"))]
    out = {x.title: x for x in entries.assembled(make("pages", p), make("redirects", r)).collect()}
    assert set(out) == {"Donut", "Carl", "Cat"}
    d = out["Donut"]
    assert d.definition == "<b>Princess Donut</b> is a cat, really." and d.source_categories == ["Characters", "Groups"] and d.redirect_aliases == ["GC BWR", "The Cat"]
    assert [(x.label, x.value) for x in d.details] == [("Aliases", "D")] and d.spoiler_notice == "Spoilers ahead"
    assert out["Cat"].definition == d.definition and out["Cat"].details == d.details
    minimal = make("title string, url string, first_paragraph string, raw_html string, status string", [{"title": "A", "first_paragraph": "A long sentence.", "status": "ok"}])
    assert entries.assembled(minimal, make("redirects", [])).count() == 1
    assert entries.assembled(make("pages", []), make("redirects", [])).isEmpty()


def test_checks(make):
    e = make("pos bigint, title string, url string, plain string, details array<struct<label:string,value:string>>", [
        {"title": "Kimaris", "plain": "See: Somewhere Else", "details": []},
        {"title": "Gallery", "plain": "A long enough text that goes on and on until it is more than eighty characters, Art by X.", "details": []},
        {"title": "Broken", "plain": "Broken isa thing of . and so on, long enough to be longer than eighty characters in all.", "details": []},
        {"title": "Tiny", "plain": "Tiny thing.", "details": []}, {"title": "Null", "plain": None, "details": None},
        {"title": "Rats", "plain": "Rats are of the kind that lives with", "details": [("a", "b")]},
        {"title": "Fumble", "plain": "Fumble is an item.", "details": []}, {"title": "Tom", "plain": "Tom", "details": [("a", "b")]},
    ])
    kinds = {(r.title, r.kind) for r in checks.audit(e).collect()}
    assert {("Kimaris", "unresolved-forward"), ("Gallery", "gallery-credit"), ("Broken", "source-artifact"), ("Tiny", "short"), ("Rats", "truncated"), ("Null", "short")} <= kinds and ("Tiny", "truncated") not in kinds
    c = {r.title: (r.reasons, r.severity) for r in checks.cleanup(e).collect()}
    assert c["Fumble"] == ("generic-type-definition|short-definition-without-sidebar", 1) and c["Tom"][1] == 0 and "title-only-definition" in c["Tom"][0] and "Null" not in c
    assert {r.severity for r in checks.audit_severity(e).collect()} == {"fatal", "warning"}
    scoped = make("entries", [_e("Carl", categories=["Characters"], pos=1), _e("Old Box", categories=["Loot_Boxes"], pos=2), _e("None", pos=3)])
    assert rows(entries.out_of_scope(scoped, ("Characters",)), "title") == [("Old Box",)]
