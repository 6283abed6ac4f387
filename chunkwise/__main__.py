"""Command line: ``python -m chunkwise <command> ...`` (or via spark-submit).

Samples are read from Parquet: one table, several per-metric tables
(``--table name=path``, repeatable), or an events-shaped table (``--events``).
Results are written whole to ``--out`` as Parquet (text for exports); nothing is
printed but the folders and their row counts.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Params, materialize
from .model import attachments_df, indexes_df, require_samples, samples_from_events, series_dictionary
from .operators import chunks as C
from .operators import placement as P

COMMANDS = [
    "inventory", "stream-inventory", "distribution", "sizes", "old-chunks", "new-chunks", "largest-old", "placement",
    "alignment", "move", "migrate-sql", "migrate-jsonl", "push",
]


def _samples(spark: SparkSession, args) -> DataFrame:
    if args.table:
        parts = [spark.read.parquet(path).withColumn("metric", F.lit(name)) for name, path in (t.split("=", 1) for t in args.table)]
        return require_samples(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))
    if not args.samples:
        raise SystemExit("name the samples with --samples or --table")
    df = spark.read.parquet(args.samples)
    return samples_from_events(df) if args.events else require_samples(df)


def _params(args) -> Params:
    return Params(every=args.every, age=args.age, as_of=dt.datetime.fromisoformat(args.as_of), batch_size=args.batch)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
    print(f"{path}: {df.sparkSession.read.parquet(path).count()} rows")


def _transport(spec: str | None):
    """``module:name`` of a callable ``(metric, lines) -> status``; called without arguments if it is a class."""
    if spec is None:
        return None
    module, _, name = spec.partition(":")
    found = getattr(importlib.import_module(module), name)
    return found() if isinstance(found, type) else found


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="chunkwise")
    ap.add_argument("command", choices=COMMANDS)
    ap.add_argument("--samples", help="Parquet path of the samples (or events with --events)")
    ap.add_argument("--table", action="append", default=[], help="name=path of one metric's table (repeatable)")
    ap.add_argument("--events", action="store_true")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--every", default="1 day")
    ap.add_argument("--age", default="10 days")
    ap.add_argument("--as-of", dest="as_of", default=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat())
    ap.add_argument("--batch", type=int, default=10_000)
    ap.add_argument("--metric", action="append", default=[], help="metric / table name (repeatable)")
    ap.add_argument("--target-series", help="Parquet folder of the target cluster's (labels, series_id); created ids are added to it")
    ap.add_argument("--transport", help="module:callable that sends lines to the metrics store (migrate-jsonl, push)")
    ap.add_argument("--resume", action="store_true", help="do only what an earlier run into --out left undone (migrate-sql, migrate-jsonl)")
    ap.add_argument("--hot", help="stored hot tier (move)")
    ap.add_argument("--cold", help="cold tier folder (move)")
    ap.add_argument("--attachments", help="JSON list of [table, tier]")
    ap.add_argument("--indexes", help="JSON list of [schema, table, index, [columns]]")
    ap.add_argument("--block", default="[]", help="JSON list of [table number, node] (placement)")
    ap.add_argument("--allow", default="[]", help="JSON list of nodes (placement)")
    ap.add_argument("--left-states", help="Parquet of compression states of the access node (alignment)")
    ap.add_argument("--right-states", help="Parquet of compression states of the other node (alignment)")
    ap.add_argument("--settings", help="Parquet of compression settings (alignment)")
    ap.add_argument("--checkpoint", help="streaming checkpoint folder (stream-inventory)")
    ap.add_argument("--glob", default="*.parquet", help="file name pattern of new sample files (stream-inventory)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"chunkwise-{args.command}").getOrCreate()
    prm = _params(args)
    if args.command == "move":
        from .plans.mover import run_chunk_mover

        att = attachments_df(spark, [tuple(x) for x in json.loads(args.attachments)])
        idx = indexes_df(spark, [tuple(x) for x in json.loads(args.indexes or "[]")])
        run = run_chunk_mover(spark, args.hot, args.cold, args.metric, att, idx, prm)
        _write(run.plan, f"{args.out}/plan")
        _write(run.status, f"{args.out}/status")
        return
    if args.command == "push":  # lines that migrate-jsonl wrote into --out, without the export
        from .sources.ledger import push_pending
        from .sources.sinks import read_text

        if not args.transport:
            raise SystemExit("push needs --transport")
        lines = read_text(spark, f"{args.out}/lines", args.metric or None).select("metric", F.col("value").alias("line"))
        _write(push_pending(lines, _transport(args.transport), f"{args.out}/lines_push_ledger"), f"{args.out}/push_status")
        return
    if args.command == "alignment":
        from .operators.compression import compression_ddl
        from .plans.alignment import align_compression

        left, right, settings = (spark.read.parquet(p) for p in (args.left_states, args.right_states, args.settings))
        found = align_compression(left, right, settings, prm.schema)
        _write(found.drift, f"{args.out}/drift")
        _write(found.rules, f"{args.out}/rules")
        _write(compression_ddl(found.rules), f"{args.out}/statements")
        return
    if args.command == "stream-inventory":
        from .streaming.inventory import run_incremental_inventory, stream_events_as_samples

        if not args.events:
            raise SystemExit("stream-inventory reads events-shaped files (--events)")
        stream = stream_events_as_samples(spark, args.samples, args.glob)
        run_incremental_inventory(stream, args.out, args.checkpoint, every=prm.every, schema=prm.schema)
        return
    samples = _samples(spark, args)
    inventory = lambda **age: C.chunk_inventory(samples, every=prm.every, schema=prm.schema, **age)
    if args.command == "inventory":
        _write(inventory(), args.out)
    elif args.command == "old-chunks":
        _write(C.chunk_full_name(inventory(older_than=prm.cutoff)), args.out)
    elif args.command == "new-chunks":
        _write(C.chunk_full_name(inventory(newer_than=prm.cutoff)), args.out)
    elif args.command == "largest-old":
        _write(C.largest_chunks(inventory(older_than=prm.cutoff)), args.out)
    elif args.command == "sizes":
        _write(P.hypertable_sizes(inventory()), args.out)
    elif args.command == "distribution":
        _write(P.node_distribution(P.node_sizes(inventory()).drop("num_chunks")), args.out)
    elif args.command == "placement":
        tables = materialize(C.hypertable_catalog(inventory()), "hypertables")
        block, allow = P.block_plan(tables, [tuple(x) for x in json.loads(args.block)]), P.allow_plan(tables, json.loads(args.allow))
        _write(block, f"{args.out}/block")
        _write(allow, f"{args.out}/allow")
        _write(P.effective_placement(tables, block, allow), f"{args.out}/placement")
    elif args.command == "migrate-sql":
        from .plans.migrate import migrate_sql

        run = migrate_sql(samples, series_dictionary(samples), args.target_series, args.metric, prm.batch_size, prm.schema, f"{args.out}/statements", resume=args.resume)
        _write(run.status, f"{args.out}/status")
    elif args.command == "migrate-jsonl":
        from .plans.migrate import migrate_jsonl

        run = migrate_jsonl(samples, series_dictionary(samples), args.metric, prm.batch_size, f"{args.out}/lines", _transport(args.transport), resume=args.resume)
        _write(run.status, f"{args.out}/status")


if __name__ == "__main__":
    main()
