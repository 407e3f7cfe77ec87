"""spark-submit entry points.

    spark-submit vantage/plans/job.py metrics --mapping-csv m.csv --train-json t.json --val-json v.json \
        --output-dir out/ [--preview-jsonl p/ --preview-limit 20] [--skip-output-write]
    spark-submit vantage/plans/job.py mapping-index --input-csv m.csv --output-dir out/ --num-node-buckets 2
    spark-submit vantage/plans/job.py smoke --input-csv m.csv --output-csv out/ --max-viewpoints 10 --max-images 100
    spark-submit vantage/plans/job.py stage --train-json t.json --val-json v.json --output-dir tables/
    spark-submit vantage/plans/job.py metrics --mapping-csv m.csv --tables tables/ --output-dir out/
    spark-submit vantage/plans/job.py decide --candidates-csv c.csv --events-csv e.csv --output-csv d/
    spark-submit vantage/plans/job.py near-duplicates --registry r/ --mapping-csv m.csv --images-dir d/ --output-csv o/
    spark-submit vantage/plans/job.py review --candidates-csv c.csv [--decisions-csv d.csv | --log log/]
    spark-submit vantage/plans/job.py record --log log/ --pair 3 9 --decision merge
    spark-submit vantage/plans/job.py compact --log log/
    spark-submit vantage/plans/job.py insight --metrics out/ --output-dir insight/ [--min-images 1 --max-entropy 5]

Every run writes a manifest (one row per fact: configuration, row counts
collected by observations during the single pass, elapsed time).
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time
import uuid

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import Observation, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vantage import constants as K  # noqa: E402
from vantage.session import build_session, free_scratch, scratch_path  # noqa: E402


def _common(p: argparse.ArgumentParser) -> None:
    p.add_argument("--master", default=None)
    p.add_argument("--app-name", default="vantage")
    # An upper bound: AQE coalesces small partitions but never splits large
    # ones, so size it to the input (about input bytes / 128 MB).
    p.add_argument("--shuffle-partitions", type=int, default=2000)
    p.add_argument("--default-parallelism", type=int, default=None)
    p.add_argument("--manifest-dir", default=None, help="where the run manifest goes (default: next to the output)")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Viewpoint traffic analytics jobs.")
    sub = parser.add_subparsers(dest="command", required=True)

    m = sub.add_parser("metrics", help="per-viewpoint traffic metrics")
    _common(m)
    m.add_argument("--mapping-csv", required=True)
    m.add_argument("--train-json", default=None)
    m.add_argument("--val-json", default=None)
    m.add_argument("--tables", default=None, help="folder of a stage run, instead of the two documents")
    m.add_argument("--output-dir", required=True)
    m.add_argument("--skip-output-write", action="store_true")
    m.add_argument("--preview-jsonl", default=None)
    m.add_argument("--preview-limit", type=int, default=K.PREVIEW_LIMIT)
    m.add_argument("--vehicle-rules", default="default", choices=["default"])

    g = sub.add_parser("mapping-index", help="grouped mapping and balanced buckets")
    _common(g)
    g.add_argument("--input-csv", required=True)
    g.add_argument("--output-dir", required=True)
    g.add_argument("--num-node-buckets", type=int, default=K.NODE_BUCKETS)

    s = sub.add_parser("smoke", help="first K viewpoints, at most N images")
    _common(s)
    s.add_argument("--input-csv", required=True)
    s.add_argument("--output-csv", required=True)
    s.add_argument("--max-viewpoints", type=int, default=K.SMOKE_MAX_VIEWPOINTS)
    s.add_argument("--max-images", type=int, default=K.SMOKE_MAX_IMAGES)

    t = sub.add_parser("stage", help="explode COCO documents once into Parquet tables")
    _common(t)
    t.add_argument("--train-json", required=True)
    t.add_argument("--val-json", required=True)
    t.add_argument("--output-dir", required=True)

    n = sub.add_parser("near-duplicates", help="candidate viewpoint pairs for review")
    _common(n)
    n.add_argument("--registry", required=True, help="registry folder (viewpoints and state tables)")
    n.add_argument("--dim", type=int, default=K.EMBEDDING_DIM, help="length of the centroids")
    n.add_argument("--mapping-csv", required=True)
    n.add_argument("--images-dir", required=True, nargs="+")
    n.add_argument("--output-csv", required=True)
    n.add_argument("--threshold", type=float, default=K.PAIR_THRESHOLD)
    n.add_argument("--max-candidates", type=int, default=K.MAX_CANDIDATES)
    n.add_argument("--pivots", type=int, default=64, help="pivots of a cell of the pair search (below 2: no cells)")

    r = sub.add_parser("review", help="check a decision file against its candidates; progress")
    _common(r)
    r.add_argument("--candidates-csv", required=True)
    r.add_argument("--decisions-csv", default=None, help="absent: nothing decided yet")
    r.add_argument("--log", default=None, help="decision log instead of a decision file")

    d = sub.add_parser("decide", help="write decisions onto the candidates, in candidate order")
    _common(d)
    d.add_argument("--candidates-csv", required=True)
    d.add_argument("--events-csv", required=True,
                   help="header viewpoint_id_a,viewpoint_id_b,merge_decision,notes; a later row of a pair wins")
    d.add_argument("--output-csv", required=True)

    o = sub.add_parser("record", help="append one decision to a decision log")
    _common(o)
    o.add_argument("--log", required=True, help="folder of the decision log")
    o.add_argument("--pair", type=int, nargs=2, required=True, metavar=("A", "B"))
    o.add_argument("--decision", required=True, choices=["merge", "no_merge", "none"], help="none takes a decision back")
    o.add_argument("--notes", default="")

    k = sub.add_parser("compact", help="fold a decision log into its next snapshot")
    _common(k)
    k.add_argument("--log", required=True)

    i = sub.add_parser("insight", help="the tables behind the insight page")
    _common(i)
    i.add_argument("--metrics", required=True, help="metrics Parquet folder or JSON-lines file")
    i.add_argument("--output-dir", required=True)
    i.add_argument("--min-images", type=int, default=1)
    i.add_argument("--max-entropy", type=float, default=5.0)
    i.add_argument("--top-n", type=int, default=20)
    i.add_argument("--bins", type=int, default=40)
    i.add_argument("--viewpoint-id", type=int, default=None, help="drill-down (default: first id)")
    return parser


def session_for(args) -> SparkSession:
    return build_session(args.app_name, master=args.master, shuffle_partitions=args.shuffle_partitions,
                         default_parallelism=args.default_parallelism)


def write_manifest(spark: SparkSession, path: str, facts: dict) -> None:
    sc = spark.sparkContext
    base = {
        "app_id": sc.applicationId,
        "master": sc.master,
        "default_parallelism": sc.defaultParallelism,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
    }
    base.update(facts)
    rows = [(k, str(v)) for k, v in base.items()]
    spark.createDataFrame(rows, "fact string, value string").coalesce(1).write.mode("overwrite").json(path)


class Steps:
    """The run's evidence step by step: one appended row per finished step and
    attempt, so a rerun can be told from the run before it, and a run that
    stopped shows how far it came."""

    SCHEMA = "app_id string, attempt string, step string, rows long, seconds double, problems string"

    def __init__(self, spark: SparkSession, manifest: str):
        self.spark, self.t0 = spark, time.time()
        self.path = f"{manifest.rstrip('/')}_steps"
        self.attempt = time.strftime("%Y%m%dT%H%M%S", time.gmtime(self.t0)) + f"-{uuid.uuid4().hex[:6]}"

    def done(self, step: str, rows: int, **problems: int) -> None:
        row = [(self.spark.sparkContext.applicationId, self.attempt, step, int(rows), round(time.time() - self.t0, 3), json.dumps(problems))]
        self.spark.createDataFrame(row, self.SCHEMA).coalesce(1).write.mode("append").json(self.path)


def run_metrics(args) -> dict:
    from vantage.operators import metrics as M
    from vantage.operators.normalize import normalize_annotations, normalize_categories, normalize_images
    from vantage.sources.coco import read_coco_splits, read_staged
    from vantage.sources.mapping import read_mapping_csv
    from vantage.sources.sinks import write_preview_jsonl

    spark = session_for(args)
    t0 = time.time()
    if args.tables:
        images, anns, cats = read_staged(spark, args.tables)
    elif args.train_json and args.val_json:
        images, anns, cats = read_coco_splits(spark, {"train": args.train_json, "val": args.val_json})
    else:
        raise SystemExit("metrics needs --tables, or --train-json and --val-json")
    obs = {k: Observation(k) for k in ("mapping", "joined", "images", "viewpoints")}
    mapping = read_mapping_csv(spark, args.mapping_csv, ordered=False).observe(obs["mapping"], F.count(F.lit(1)).alias("rows"))
    inputs = M.TrafficInputs(normalize_images(images), normalize_annotations(anns), normalize_categories(cats),
                             mapping, observations={k: obs[k] for k in ("joined", "images")})
    result = M.viewpoint_metrics(inputs)
    # observed above the sort: the range-partition sampling pass does not run it
    ordered = result.orderBy(F.col("viewpoint_id").asc()).observe(obs["viewpoints"], F.count(F.lit(1)).alias("rows"))
    if args.skip_output_write:
        ordered.write.format("noop").mode("overwrite").save()
    else:
        ordered.write.mode("overwrite").parquet(args.output_dir)
    facts = {f"{k}_rows": o.get.get("rows") for k, o in obs.items()}
    if args.preview_jsonl:
        write_preview_jsonl(spark.read.parquet(args.output_dir) if not args.skip_output_write else result,
                            args.preview_jsonl, args.preview_limit)
    facts["elapsed_s"] = round(time.time() - t0, 2)
    write_manifest(spark, args.manifest_dir or f"{args.output_dir.rstrip('/')}_manifest", facts)
    return facts


def kept(df, name: str):
    """``df`` written once to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_mapping_index(args, spark: SparkSession | None = None) -> dict:
    from vantage.operators import mapping_index as MI
    from vantage.operators.checks import RuleCounters
    from vantage.sources.mapping import read_mapping_trimmed
    from vantage.sources.sinks import write_bucket_files, write_grouped

    spark = spark or session_for(args)
    steps = Steps(spark, args.manifest_dir or f"{args.output_dir.rstrip('/')}/_manifest")
    read = RuleCounters("mapping", {"no image id": F.col("image_id").isNull(), "no viewpoint id": F.col("viewpoint_id").isNull()})
    mapping = kept(read.watch(read_mapping_trimmed(spark, args.input_csv)), "mapping")
    steps.done("mapping", read.rows, **read.broken())
    sized = RuleCounters("sizes", {})
    sizes = kept(sized.watch(MI.viewpoint_sizes(mapping)), "sizes")
    steps.done("viewpoints", sized.rows)
    out = args.output_dir.rstrip("/")
    write_grouped(MI.mapping_ranks(mapping), sizes, out)
    steps.done("grouped", sized.rows)
    dealt = RuleCounters("assignment", {"no bucket": F.col("bucket_id").isNull()})
    assignment = kept(dealt.watch(MI.assign_sizes(sizes, args.num_node_buckets)), "assignment")
    steps.done("assignment", dealt.rows, **dealt.broken())
    write_bucket_files(assignment, MI.bucket_totals(assignment, args.num_node_buckets), MI.bucket_members(assignment), out)
    facts = {"rows": read.rows, "viewpoints": sized.rows, "buckets": args.num_node_buckets}
    steps.done("buckets", args.num_node_buckets)
    write_manifest(spark, args.manifest_dir or f"{out}/_manifest", facts)
    return facts


def run_smoke(args) -> dict:
    from vantage.operators import mapping_index as MI
    from vantage.operators.checks import RuleCounters
    from vantage.sources.mapping import read_mapping_trimmed
    from vantage.sources.sinks import write_mapping_csv

    spark = session_for(args)
    steps = Steps(spark, args.manifest_dir or f"{args.output_csv.rstrip('/')}_manifest")
    subset = MI.smoke_subset(read_mapping_trimmed(spark, args.input_csv), args.max_viewpoints, args.max_images)
    seen = RuleCounters("smoke", {})
    write_mapping_csv(seen.watch(subset.orderBy("seq")), args.output_csv)
    steps.done("smoke", seen.rows)
    return {"rows": seen.rows}


def run_stage(args) -> dict:
    from vantage.sources.coco import stage_coco

    spark = session_for(args)
    t0 = time.time()
    steps = Steps(spark, args.manifest_dir or f"{args.output_dir.rstrip('/')}_manifest")
    facts = stage_coco(spark, {"train": args.train_json, "val": args.val_json}, args.output_dir, strict=True)
    for name, rows in facts.items():
        steps.done(name, rows)
    write_manifest(spark, args.manifest_dir or f"{args.output_dir.rstrip('/')}_manifest",
                   {**facts, "elapsed_s": round(time.time() - t0, 2)})
    return facts


def run_near_duplicates(args) -> dict:
    from vantage.operators import mapping_index as MI
    from vantage.operators import review as R
    from vantage.operators import similarity as S
    from vantage.operators.checks import RuleCounters, require_nonempty
    from vantage.session import scratch_path
    from vantage.sources.files import image_path_map
    from vantage.sources.mapping import read_mapping_strict
    from vantage.sources.registry import load_registry

    spark = session_for(args)
    registry, _ = load_registry(spark, args.registry, args.dim, missing_ok=False)
    require_nonempty(registry, "the registry")
    mapping = read_mapping_strict(spark, args.mapping_csv)
    require_nonempty(mapping, "the mapping")
    found = scratch_path(spark, "near-duplicates")  # the search runs once
    search = S.search_pairs(registry, args.threshold, pivots=args.pivots)
    counted = RuleCounters("pairs", {"a pair out of order": F.col("id_a") >= F.col("id_b")})
    counted.watch(search.pairs).write.parquet(found)
    counted.enforce("similar pairs")
    every = spark.read.parquet(found)
    total = counted.rows
    pairs = every if args.max_candidates <= 0 else S.top_candidate_pairs(every, args.max_candidates)
    rows = R.pairs_with_images(pairs, MI.representative_image(mapping), image_path_map(spark, args.images_dir), strict=True)
    R.write_pair_csv(rows, args.output_csv)
    taken = total if args.max_candidates <= 0 else min(total, args.max_candidates)
    facts = {"pairs": taken, "left_out": total - taken}
    write_manifest(spark, args.manifest_dir or f"{args.output_csv.rstrip('/')}_manifest",
                   {**facts, "vectors_compared": search.compared(registry.count())})
    return facts


def run_decide(args) -> dict:
    from vantage.operators import review as R
    from vantage.sources.mapping import with_file_order

    spark = session_for(args)
    candidates = R.read_pair_csv(spark, args.candidates_csv)
    events = with_file_order(spark.read.option("header", "true").option("escape", '"').csv(args.events_csv))
    events = events.select(
        F.col("viewpoint_id_a").cast("long"), F.col("viewpoint_id_b").cast("long"), "merge_decision", "notes",
        F.col("seq").alias("event_seq"))
    decided = R.apply_decisions(candidates, events, keep=True)
    R.write_pair_csv(decided, args.output_csv)
    return {k: int(v) for k, v in R.review_progress(decided).first().asDict().items()}


def run_review(args) -> dict:
    from vantage.operators import review as R
    from vantage.operators.checks import enforce
    from vantage.sources import decision_log as L

    spark = session_for(args)
    candidates = R.read_pair_csv(spark, args.candidates_csv)
    decided = candidates
    if args.decisions_csv:
        decisions = R.read_pair_csv(spark, args.decisions_csv)
        enforce(R.check_alignment(candidates, decisions), "the decisions do not line up with the candidates")
        decided = decisions
    elif args.log:
        enforce(L.unknown_pairs(candidates, args.log), "the log decides a pair that is no candidate")
        decided = L.decided(candidates, args.log)
    progress = R.review_progress(decided).first().asDict()
    return {k: int(v) for k, v in progress.items()}


def run_record(args) -> dict:
    from vantage.sources import decision_log as L

    decision = "" if args.decision == "none" else args.decision
    return {"recorded": L.record(session_for(args), args.log, [(*args.pair, decision, args.notes)])}


def run_compact(args) -> dict:
    from vantage.sources import decision_log as L

    return {"snapshot": L.compact(session_for(args), args.log)}


def run_insight(args) -> dict:
    from vantage.operators import insight as I
    from vantage.sources.sinks import write_table

    spark = session_for(args)
    if args.metrics.endswith((".json", ".jsonl")):
        metrics = I.read_metrics_jsonl(spark, args.metrics)
    else:
        metrics = I.coerce_metrics(spark.read.parquet(args.metrics))
    filtered = I.filter_metrics(metrics, args.min_images, args.max_entropy)
    if filtered.isEmpty():
        return {"viewpoints": 0, "note": "the filters leave no viewpoint"}
    out = args.output_dir.rstrip("/")
    write_table(I.kpi_summary(filtered), f"{out}/kpis")
    write_table(I.top_congestion(filtered, args.top_n), f"{out}/top_congestion")
    write_table(I.composition_view(filtered), f"{out}/composition")
    write_table(I.congestion_histogram(filtered, args.bins), f"{out}/congestion_histogram")
    detail = I.viewpoint_detail(filtered, args.viewpoint_id)
    write_table(detail, f"{out}/viewpoint_detail")
    write_table(I.class_vector_explode(detail), f"{out}/viewpoint_classes")
    kpi = spark.read.parquet(f"{out}/kpis").first().asDict()
    return {"viewpoints": int(kpi["viewpoints"]), "total_vehicles": int(kpi["total_vehicles"])}


COMMANDS = {
    "metrics": run_metrics,
    "mapping-index": run_mapping_index,
    "smoke": run_smoke,
    "stage": run_stage,
    "near-duplicates": run_near_duplicates,
    "review": run_review,
    "decide": run_decide,
    "record": run_record,
    "compact": run_compact,
    "insight": run_insight,
}


def main(argv: list[str] | None = None) -> dict:
    args = build_parser().parse_args(argv)
    facts = COMMANDS[args.command](args)
    free_scratch(session_for(args))  # kept when the command fails
    print(facts)
    return facts


if __name__ == "__main__":
    main()
