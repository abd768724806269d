"""Catalogue storage: CSV import/export (S4), append (S5), stage writes
(S7) and the rewrite-and-verify maintenance step (S12)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import CATALOGUE
from tessera.sources.csvsplit import read_quoted_csv
from tessera.sources.ingest import project_catalogue

# Cells keep their white space: Spark's CSV writer trims by default.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_catalogue_csv(spark: SparkSession, path: str, schema: T.StructType = CATALOGUE) -> DataFrame:
    """Header CSV with multi-line quoted cells and doubled quotes, read
    with an explicit schema (never inferred), a file by many tasks. ``NA`` stays
    text."""
    return read_quoted_csv(spark, path, schema, CSV_OPTIONS)


def write_catalogue_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export (one header per part file)."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def append_catalogue(df: DataFrame, path: str) -> None:
    """Project to the fixed catalogue schema (missing columns null) and
    append to the Parquet catalogue."""
    project_catalogue(df).write.mode("append").parquet(path)


def write_stage(df: DataFrame, path: str, run_id: str, stage: str | None = None) -> None:
    """Whole-stage overwrite of one run's partition only (dynamic
    partition overwrite leaves other runs untouched)."""
    out = df.withColumn("run_id", F.lit(run_id))
    if stage is not None:
        out = out.withColumn("stage", F.lit(stage))
    parts = ["run_id"] + (["stage"] if stage is not None else [])
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds any file, on whatever store Spark reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop) and len(fs.listStatus(hadoop)) > 0


MANIFEST = "_manifest"
NO_MANIFEST: dict = {"removed": [], "added": []}


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest(spark: SparkSession, path: str) -> dict:
    """What rewrites have replaced so far: file names that no longer count, and
    the files that count besides those in the folder."""
    hadoop, at, fs = _fs(spark, path)
    file = hadoop.Path(at, MANIFEST)
    if not fs.exists(file):
        return NO_MANIFEST
    stream = fs.open(file)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _files(spark: SparkSession, path: str) -> list[str]:
    """The names of all files under a path, as seen from it."""
    _, at, fs = _fs(spark, path)
    root, found, walk = fs.makeQualified(at).toUri().getPath().rstrip("/") + "/", [], fs.listFiles(at, True)
    while walk.hasNext():
        found.append(walk.next().getPath().toUri().getPath()[len(root):])
    return found


def _plain(name: str) -> bool:
    return not any(part[0] in "_." for part in name.split("/"))


def _parts(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(folder, names of files in it) of the folder itself and of each rewrite,
    as the manifest has them."""
    manifest, base = _manifest(spark, path), path.rstrip("/")
    gone = set(manifest["removed"])
    parts = [(base, sorted(f for f in _files(spark, path) if _plain(f) and f not in gone))]
    for version in sorted({f.split("/", 1)[0] for f in manifest["added"]}):
        parts.append((f"{base}/{version}", [f.split("/", 1)[1] for f in manifest["added"] if f.startswith(version + "/")]))
    return [(folder, names) for folder, names in parts if names]


def _opened(spark: SparkSession, schema: T.StructType, folder: str, names: Iterable[str]) -> DataFrame:
    return spark.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/{n}" for n in names])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as its last rewrite left it, with what was appended
    since. A table that was never rewritten is read as it lies."""
    if _manifest(spark, path) == NO_MANIFEST:
        return spark.read.parquet(path)
    schema = spark.read.parquet(path).schema
    parts = [_opened(spark, schema, *part).select(*schema.names) for part in _parts(spark, path)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def overwrite_and_verify(spark: SparkSession, path: str, keep: F.Column, reject: F.Column) -> dict:
    """Rewrite the table without rejected rows, by versions.

    Only files that hold a rejected row are written again, into a folder of
    their own that plain reads pass over; the others stay as they are. The new
    files are checked (kept = before - rejected, none left to reject), and then
    one rename of the manifest makes them the table, as ``read_table`` reads it.
    Until then, and if anything fails before, the table is the old one; a lost
    driver leaves files that nothing names. The old files are left for readers
    that still use them; ``drop_replaced`` removes them."""
    src = read_table(spark, path)
    rejected_if = F.coalesce(reject, F.lit(False)).cast("int")
    before, rejected = src.agg(F.count("*"), F.coalesce(F.sum(rejected_if), F.lit(0))).first()
    _, at, fs = _fs(spark, path)
    base, root = path.rstrip("/"), fs.makeQualified(at).toUri().getPath().rstrip("/") + "/"
    names, old = set(), []
    for folder, files in _parts(spark, path):
        part = _opened(spark, src.schema, folder, files)
        # One row for each file that is written again.
        hit = [r["file"] for r in part.filter(reject).select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
        here = [spark.sparkContext._jvm.java.net.URI(h).getPath()[len(root):] for h in hit]
        names.update(here)
        if here:
            inside = folder[len(base) + 1:]
            old.append(_opened(spark, src.schema, folder, [n[len(inside) + 1:] if inside else n for n in here]).select(*src.columns))
    if not names:
        return {"before": before, "kept": before, "after": before, "remaining_rejected": 0, "rewritten": 0}
    old = reduce(DataFrame.unionByName, old)
    version = f"_rewrite-{uuid.uuid4().hex[:12]}"
    parts = [f.name for f in src.schema.fields if any(f"{f.name}=" in n for n in names)]
    out = old.filter(keep).write.mode("overwrite")
    (out.partitionBy(*parts) if parts else out).parquet(f"{base}/{version}")
    new = spark.read.schema(src.schema).parquet(f"{base}/{version}")
    n, left = new.agg(F.count("*"), F.coalesce(F.sum(rejected_if), F.lit(0))).first()
    expected = old.count() - rejected
    if n != expected or left:
        raise RuntimeError(f"rewrite of {path}: {n} rows in {version}, {left} of them rejected; {expected} were to stay")
    manifest = _manifest(spark, path)
    added = [f"{version}/{f}" for f in _files(spark, f"{base}/{version}") if _plain(f)]
    _switch(spark, path, {
        "removed": sorted({*manifest["removed"], *(n for n in names if n not in manifest["added"])}),
        "added": sorted([*added, *(f for f in manifest["added"] if f not in names)]),
    })
    kept = before - rejected
    after, left = read_table(spark, path).agg(F.count("*"), F.coalesce(F.sum(rejected_if), F.lit(0))).first()
    if after != kept or left:
        raise RuntimeError(f"rewrite of {path}: the table holds {after} rows, {left} of them rejected; {kept} were to stay")
    return {"before": before, "kept": kept, "after": after, "remaining_rejected": 0, "rewritten": len(names)}


def _switch(spark: SparkSession, path: str, manifest: dict) -> None:
    """Write a manifest beside the old one and rename it over it."""
    hadoop, at, fs = _fs(spark, path)
    draft = hadoop.Path(at, f"{MANIFEST}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(draft)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, hadoop.Path(at, MANIFEST), options)


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the files that rewrites have replaced; how many there were."""
    hadoop, at, fs = _fs(spark, path)
    manifest = _manifest(spark, path)
    return sum(bool(fs.delete(hadoop.Path(at, name), False)) for name in manifest["removed"])
