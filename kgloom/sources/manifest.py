"""Manifest and provenance of a graph root: what each table holds, as sums over its files.

A file's rows are summed once; while it has its path, size and time, its sums are
taken from the manifest before.  A table's fingerprint is that of the added sums,
so it does not depend on how rows lie in files.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import PARTS, added, digest_sums, fingerprint
from ..functions.schema import RELATIONS
from . import files
from .store import KGRoot

LAYERS = ("nodes", "edges", "evidence", "features")
SUMS = "layer string, name string, path string, bytes long, modified long, n_rows long, " + ", ".join(f"sum_{k} decimal(38,0)" for k in range(PARTS))


def _folder(root: KGRoot) -> str:
    return f"{root.uri}/metadata/manifest"


def _last(root: KGRoot) -> DataFrame | None:
    done = [n for n in files.names(root.spark, _folder(root)) if n.isdigit()]
    return root.spark.read.schema(SUMS).parquet(f"{_folder(root)}/{done[-1]}") if done else None


def labels(layer: str, name: str) -> list[str]:
    out = ["kg", "kg-v2", "canonical", f"kg-layer:{layer}"]
    if layer == "nodes":
        out.append(f"node_type:{name}")
    elif layer in ("edges", "evidence"):
        out.append(f"relation:{name}")
        if name in RELATIONS:
            r = RELATIONS[name]
            out += [f"x_type:{r.source}", f"y_type:{r.target}", f"kind:{r.kind}", f"direct:{'yes' if r.direct else 'no'}"]
    else:
        out += ["feature", f"node_type:{name.split('_', 1)[0]}"]
    return sorted(set(out))


def update_manifest(root: KGRoot) -> tuple[DataFrame, list[str]]:
    """The manifest of the root's tables as they are now, written beside earlier ones, and the files that were read for it."""
    spark = root.spark
    listed = [(layer, name, f.path, f.bytes, f.modified) for layer in LAYERS for name in root.tables(layer) for f in files.data_files(spark, root.path(layer, name))]
    now = spark.createDataFrame(listed, "layer string, name string, path string, bytes long, modified long")
    old = _last(root)
    same = ["layer", "name", "path", "bytes", "modified"]
    kept = old.join(now, same, "left_semi") if old is not None else spark.createDataFrame([], SUMS)
    fresh = now.join(kept, same, "left_anti").collect()  # a row a new file
    out = kept.select([c for c in kept.columns])
    by: dict[tuple[str, str], list] = {}
    for r in fresh:
        by.setdefault((r["layer"], r["name"]), []).append(r)
    for (layer, name), rows in by.items():
        df = spark.read.option("mergeSchema", True).parquet(*[r["path"] for r in rows])
        sums = df.withColumn("_path", F.col("_metadata.file_path")).groupBy("_path").agg(*digest_sums(df.columns))
        facts = spark.createDataFrame([tuple(r[c] for c in same) for r in rows], "layer string, name string, path string, bytes long, modified long")
        strip = lambda c: F.regexp_replace(c, "^file:/+", "/")
        counted = facts.join(sums, strip(F.col("path")) == strip(F.col("_path")), "left").drop("_path")
        zero = {c: F.coalesce(c, F.lit(0)).cast("long" if c == "n_rows" else "decimal(38,0)") for c in ("n_rows", *[f"sum_{k}" for k in range(PARTS)])}
        out = out.unionByName(counted.withColumns(zero))
    number = max([-1, *[int(n) for n in files.names(spark, _folder(root)) if n.isdigit()]]) + 1
    out.select([f.split(" ")[0] for f in SUMS.replace("decimal(38,0)", "decimal").split(", ")]).write.mode("overwrite").parquet(f"{_folder(root)}/{number:06d}")
    return _last(root), [r["path"] for r in fresh]


def table_entries(root: KGRoot, manifest: DataFrame) -> DataFrame:
    """layer, name, key, uri, n_rows, bytes, n_files, columns, dtypes, schema_sha256, fingerprint, labels of each table."""
    facts = []
    for layer in LAYERS:
        for name in root.tables(layer):
            schema = root.read(layer, name).schema
            dtypes = [f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields]
            facts.append((layer, name, f"kg/v2/{layer}/{name}.parquet", root.path(layer, name), schema.names, dtypes, ";".join(dtypes), labels(layer, name)))
    known = root.spark.createDataFrame(facts, "layer string, name string, key string, uri string, columns array<string>, dtypes array<string>, _schema string, labels array<string>")
    sums = added(manifest, ["layer", "name"]).join(manifest.groupBy("layer", "name").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n_files")), ["layer", "name"])
    joined = known.join(sums, ["layer", "name"], "left")
    return joined.select("layer", "name", "key", "uri", "n_rows", "bytes", "n_files", "columns", "dtypes", F.sha2("_schema", 256).alias("schema_sha256"), fingerprint().alias("fingerprint"), "labels")


def write_provenance(root: KGRoot, sources: dict, code_sha: str, code_version: str, extra: dict | None = None) -> str:
    """metadata/provenance.json of the root: when, by which code, from which sources."""
    told = {"generated_at": datetime.now(timezone.utc).isoformat(), "code_sha": code_sha, "code_version": code_version, "sources": sources, **(extra or {})}
    path = f"{root.uri}/metadata/provenance.json"
    files.write_text(root.spark, path, json.dumps(told, indent=2, sort_keys=True) + "\n")
    return path


def read_provenance(root: KGRoot) -> dict:
    return json.loads(files.read_text(root.spark, f"{root.uri}/metadata/provenance.json"))


def _size(n: int) -> str:
    value, units = float(n), ["B", "KB", "MB", "GB", "TB"]
    while value >= 1024 and len(units) > 1:
        value /= 1024
        units.pop(0)
    return f"{value:.1f} {units[0]}"


def finalise(root: KGRoot, sources: dict, code_version: str, code_sha: str | None = None) -> dict:
    """Provenance with row counts, and metadata/SUMMARY.md, from a manifest of the root as it is now."""
    manifest, _ = update_manifest(root)
    tables = manifest.where("layer IN ('nodes', 'edges')").groupBy("layer", "name").agg(F.sum("n_rows").alias("n"), F.sum("bytes").alias("b")).orderBy("layer", "name").collect()  # a row a table
    counts = {layer: {r["name"]: r["n"] for r in tables if r["layer"] == layer} for layer in ("nodes", "edges")}
    counts |= {"total_rows": sum(r["n"] for r in tables), "total_bytes": sum(r["b"] for r in tables)}
    write_provenance(root, sources, code_sha or "unknown", code_version, {"row_counts": counts})
    lines = ["# KG Export Summary", f"Root: {root.uri}", f"Code version: {code_version}", f"Code SHA: {code_sha or 'unknown'}"]
    for layer, title in (("nodes", "Node files"), ("edges", "Edge files")):
        lines += ["", f"## {title}", *[f"- {r['name']}: {r['n']} rows ({_size(r['b'])})" for r in tables if r["layer"] == layer]]
    lines += ["", f"Total rows: {counts['total_rows']} ({_size(counts['total_bytes'])})"]
    files.write_text(root.spark, f"{root.uri}/metadata/SUMMARY.md", "\n".join(lines) + "\n")
    return counts
