"""Project settings: validated JSON as frozen records whose values become literals of a plan."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from ..functions.markup import SIDEBAR_LABELS


@dataclass(frozen=True)
class SidebarField:
    source: str
    label: str
    alias: bool = False


@dataclass(frozen=True)
class LookupRules:
    """How lookup words are made from titles; the defaults are the first project's."""

    suffixes: tuple[str, ...] = (" Spell", " Box", " Achievement", " Potion", " Scroll")
    prefixes: tuple[str, ...] = ("Potion of ", "Scroll of ", "Ring of ", "Wand of ")
    strip_parenthetical: bool = True
    ignore_words: tuple[str, ...] = ()
    alias_labels: tuple[str, ...] = ("Aliases",)
    sidebar_aliases: bool = True
    human_names: bool = True


@dataclass(frozen=True)
class Project:
    wiki: str
    title: str
    author: str
    source_name: str
    categories: tuple[str, ...]
    database_path: str
    build_dir: str
    sidebar_fields: tuple[SidebarField, ...] = tuple(SidebarField(s, label, label == "Aliases") for s, label in SIDEBAR_LABELS)
    rules: LookupRules = field(default_factory=LookupRules)
    max_summary_length: int | None = None
    smoke_headwords: tuple[str, ...] = ()
    kobo_output_name: str = "dicthtml.zip"

    @property
    def base_name(self) -> str:
        return re.sub(r"^-+|-+$", "", re.sub(r"[^A-Za-z0-9]+", "-", self.title)) or "Dictionary"


def _text(data: dict, key: str) -> str:
    value = data.get(key)
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"config field {key!r} must be a non-empty string")
    return value


def _texts(data: dict, key: str, least: int = 0) -> tuple[str, ...]:
    value = data.get(key, [])
    if not isinstance(value, list) or not all(isinstance(x, str) for x in value) or len(value) < least:
        raise ValueError(f"config field {key!r} must be a list of strings")
    return tuple(value)


def project_from(data: dict) -> Project:
    """A project from parsed JSON; raises ValueError where a field is missing or odd."""
    fields = tuple(SidebarField(_text(x, "source"), _text(x, "label"), bool(x.get("alias", False))) for x in data.get("sidebar_fields", []))
    if len({f.source for f in fields}) != len(fields):
        raise ValueError("sidebar sources must be unique")
    most = data.get("max_summary_length")
    if most is not None and (not isinstance(most, int) or isinstance(most, bool) or most <= 0):
        raise ValueError("max_summary_length must be a positive integer")
    aliases = data.get("title_aliases", {})
    labels = tuple(dict.fromkeys(f.label for f in fields if f.alias)) or ("Aliases",)
    rules = LookupRules(
        suffixes=_texts(aliases, "suffixes"),
        prefixes=_texts(aliases, "prefixes"),
        strip_parenthetical=bool(aliases.get("strip_parenthetical", True)),
        ignore_words=_texts(aliases, "component_ignore_words"),
        alias_labels=labels,
    )
    more = {"sidebar_fields": fields} if fields else {}
    return Project(
        # fixed values: keys of the settings file
        *(_text(data, k) for k in ("fandom", "title", "author", "source_name")),
        categories=_texts(data, "categories", 1),
        database_path=_text(data, "database_path"),
        build_dir=_text(data, "build_dir"),
        rules=rules,
        max_summary_length=most,
        smoke_headwords=_texts(data, "smoke_headwords"),
        kobo_output_name=data.get("kobo_output_name") or "dicthtml.zip",
        **more,
    )


def load_project(path: str | Path) -> Project:
    return project_from(json.loads(Path(path).read_text("utf-8")))
