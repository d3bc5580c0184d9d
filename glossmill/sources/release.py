"""Releases: digests of files, archives, a manifest, and an install that never leaves half a folder."""

from __future__ import annotations

import json
import os
import shutil
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(name, size, sha256) of the files of a folder, hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def write_archive(path: str | Path, files: list[str | Path], texts: dict[str, str] | None = None) -> None:
    """A deflated zip of files by their names, with notes as further members."""
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, Path(f).name)
        for name, text in sorted((texts or {}).items()):
            z.writestr(name, text)


def write_manifest(spark: SparkSession, folder: str | Path, facts: dict) -> dict:
    """manifest.json and SHA256SUMS of the files that are in ``folder``."""
    folder = Path(folder)
    rows = [r.asDict() for r in digests(spark, str(folder)).orderBy("name").collect() if r.name not in ("manifest.json", "SHA256SUMS")]
    manifest = {"manifest_version": 2, **facts, "files": rows}
    (folder / "manifest.json").write_text(json.dumps(manifest, ensure_ascii=False, indent=2, sort_keys=True) + "\n", "utf-8")
    (folder / "SHA256SUMS").write_text("".join(f"{r['sha256']}  {r['name']}\n" for r in rows), "utf-8")
    return manifest


def install(staged: str | Path, final: str | Path) -> None:
    """Moves a staged folder into place; an older version is put back if that fails."""
    staged, final = Path(staged), Path(final)
    final.parent.mkdir(parents=True, exist_ok=True)
    backup = final.with_name(final.name + ".old")
    if backup.exists():
        shutil.rmtree(backup)
    if final.exists():
        os.replace(final, backup)
    try:
        os.replace(staged, final)
    except OSError:
        if backup.exists():
            os.replace(backup, final)
        raise
    shutil.rmtree(backup, ignore_errors=True)
