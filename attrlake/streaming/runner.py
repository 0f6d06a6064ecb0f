"""Job registry and runner (R2-R5, ST10).

A job is ``layer.name`` -> ``start(spark, lake, settings) -> [StreamingQuery]``.
``run_jobs`` starts the named jobs; with ``available_now`` it runs the layers
one after the other and waits for *each* query (a finished query must not
end the run early), otherwise it starts them all and blocks until one stops.
Config comes from a small YAML file (``load_config``), with every job
getting its own checkpoint folder below one root.
"""

from __future__ import annotations

import logging
import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from attrlake.functions.codec import registry_schema_string
from attrlake.operators import bronze as B
from attrlake.operators import dims as D
from attrlake.operators import facts as A
from attrlake.schemas import COLUMN_NAMES
from attrlake.store import LakeTable, _children
from attrlake.streaming import deltas as K
from attrlake.streaming import losses as L
from attrlake.streaming import pipeline as P

log = logging.getLogger("attrlake.runner")


@dataclass
class Lake:
    """Where each table of the pipeline lives: folders below ``root``
    (parquet) or ``<root>.<layer>.<table>`` in a catalog (iceberg)."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    files_per_partition: int | None = None  # see LakeTable.files_per_partition
    dim_buckets: int = P.DIM_BUCKETS        # hash buckets of dimensions and current state
    # How new dimensions and current-state tables take their upserts: "buckets"
    # (updated hash buckets are rewritten) or "deltas" (appended, folded on
    # read).  A table that is there keeps its form.
    keyed: str = "buckets"
    # Silver's days split into this many device buckets, so that refreshed
    # facts read the touched buckets only.  Fixed once silver holds rows.
    day_buckets: int | None = None
    compact_every: int | None = 64          # deltas of a keyed table until it is compacted

    def _t(self, layer: str, name: str, partition_by: list[str]) -> LakeTable:
        if self.fmt == "iceberg":
            return LakeTable(self.spark, f"{self.root}.{layer}.{name}", partition_by, fmt="iceberg",
                             files_per_partition=self.files_per_partition)
        return LakeTable(self.spark, f"{self.root.rstrip('/')}/{layer}/{name}", partition_by,
                         files_per_partition=self.files_per_partition)

    @property
    def messages(self) -> LakeTable:
        """Every message of the topic by ``reason`` and day."""
        return self._t("bronze", "messages", ["reason", "event_date"])

    @property
    def bronze(self) -> LakeTable:
        """The good messages."""
        return replace(self.messages, rows=f"reason = '{B.GOOD}'", columns=[*COLUMN_NAMES, "event_date", *B.LINEAGE])

    @property
    def quarantine(self) -> LakeTable:
        """The damaged ones: raw bytes, topic position and reason."""
        return replace(self.messages, rows=f"reason not in ('{B.GOOD}', 'tombstone')", columns=[
            *[f"raw_{c} as {c}" for c in B.RAW], "source_partition as partition", "source_offset as offset", "reason"])

    @property
    def silver(self) -> LakeTable:
        if self.day_buckets:
            if self.fmt != "parquet":
                raise ValueError("device buckets below the day are for parquet lakes")
            return replace(self._t("silver", "events", ["event_date", "bucket"]), buckets=self.day_buckets)
        return self._t("silver", "events", ["event_date"])

    def _deltas(self, location: str) -> bool:
        if self.keyed not in ("buckets", "deltas"):
            raise ValueError(f"no keyed table form {self.keyed!r}")
        if self.fmt != "parquet":
            return False
        held = _children(self.spark, location)
        if any(c.startswith("bucket=") for c in held):
            return False
        return self.keyed == "deltas" or "delta" in held or "base" in held

    @property
    def current(self) -> LakeTable | K.DeltaTable:
        """Current state per id (ST4b), delete markers kept."""
        location = f"{self.root.rstrip('/')}/silver/current"
        if self._deltas(location):
            return K.current_state_table(self.spark, location, compact_every=self.compact_every)
        return replace(self._t("silver", "current", ["bucket"]), buckets=self.dim_buckets)

    def dim(self, name: str) -> LakeTable | K.DeltaTable:
        location = f"{self.root.rstrip('/')}/gold/{name}"
        if self._deltas(location):
            return K.dimension_table(self.spark, location, name, self.compact_every)
        return replace(self._t("gold", name, ["bucket"]), buckets=self.dim_buckets)

    def fact(self, name: str) -> LakeTable:
        return self._t("gold", name, ["event_date"])

    def parts(self, name: str) -> LakeTable | None:
        """A fact within each device bucket of its days (with ``day_buckets``)."""
        return self._t("gold", f"{name}_parts", ["event_date", "bucket"]) if self.day_buckets else None


Start = Callable[[SparkSession, Lake, P.StreamSettings, "DataFrame | None"], list[StreamingQuery]]


def _bronze(spark, lake, settings, topic):
    if topic is None:
        raise ValueError("the bronze job needs a topic source")
    started = P.start_bronze(topic, lake.bronze, settings)
    if settings.offset_patience is not None:
        started.append(L.start_offset_guard(topic, _offset_state(settings), settings, settings.offset_patience))
    return started


def _offset_state(settings: P.StreamSettings) -> str:
    return f"{settings.checkpoint.rstrip('/')}/offset_runs"


def _silver(spark, lake, settings, _topic):
    if settings.silver_mode not in ("batch", "state"):
        raise ValueError(f"the silver job has no mode {settings.silver_mode!r}")
    start = P.start_silver_with_state if settings.silver_mode == "state" else P.start_silver
    return [start(spark, lake.bronze, lake.silver, settings)]


def _dim(name: str) -> Start:
    return lambda spark, lake, settings, _t: [
        P.start_dimension(spark, lake.silver, lake.dim(name), name, settings)]


def _fact(name: str) -> Start:
    def start(spark, lake, settings, _t):
        if settings.fact_mode == "refresh":
            return [P.start_fact_refresh(spark, lake.silver, lake.fact(name), name, settings, lake.parts(name))]
        if settings.fact_mode == "window" and name in P.STREAM_FACTS:
            return [P.start_fact_upsert(spark, lake.silver, lake.fact(name), name, settings, settings.watermark)]
        raise ValueError(f"gold.{name} has no mode {settings.fact_mode!r}")
    return start


def _current(spark, lake, settings, topic):
    if topic is None:
        raise ValueError("the current-state job needs a topic of change envelopes")
    from attrlake.schemas import bronze_schema

    return [P.start_current_state(spark, topic, bronze_schema(), lake.current, settings)]


def gold_targets(lake: Lake):
    """Every dimension and fact table by name."""
    return {name: lake.dim(name) for name in D.DIMENSIONS}, {name: lake.fact(name) for name in A.FACTS}


def _silver_and_gold(spark, lake, settings, _topic):
    if lake.day_buckets:
        raise ValueError("the combined job refreshes whole days; with day_buckets run the silver and gold jobs")
    dims, facts = gold_targets(lake)
    return [P.start_silver_and_gold(spark, lake.bronze, lake.silver, dims, facts, settings)]


JOBS: dict[str, Start] = {
    "bronze.topic_to_bronze": _bronze,
    "silver.bronze_to_silver": _silver,
    "gold.dim_app": _dim("dim_app"),
    "gold.dim_campaign": _dim("dim_campaign"),
    **{f"gold.{n}": _fact(n) for n in A.FACTS},
    # Alternative to the silver job plus every gold job: one micro-batch job
    # from bronze (no silver folder listed per trigger).  Not in the default set.
    "silver.bronze_to_silver_and_gold": _silver_and_gold,
    # For a topic that carries change envelopes (no unwrap in the connector):
    # last state per id, deletes applied.  Not in the default set.
    "silver.changes_to_current": _current,
}
OPT_IN_JOBS = ("silver.bronze_to_silver_and_gold", "silver.changes_to_current")
DEFAULT_JOBS = [n for n in JOBS if n not in OPT_IN_JOBS]
# Jobs that write the same table must not run together.
EXCLUSIVE = [
    ({"silver.bronze_to_silver_and_gold"}, {"silver.bronze_to_silver", "gold.dim_app", "gold.dim_campaign",
                                           *[f"gold.{n}" for n in A.FACTS]}),
]
LAYER_ORDER = ["bronze", "silver", "gold"]


CONFIG_KEYS = {"offset_patience", "trigger_interval", "max_files_per_trigger", "max_offsets_per_trigger", "min_partitions",
               "shuffle_partitions", "watermark", "mode", "codec", "schema_registry_url", "schema_subject"}


def _reader_schema(cfg: dict) -> str | None:
    """The Avro reader schema, fetched once when the job starts."""
    if cfg.get("codec", "json") != "avro":
        return None
    missing = {"schema_registry_url", "schema_subject"} - set(cfg)
    if missing:
        raise ValueError(f"the avro codec needs {sorted(missing)}")
    return registry_schema_string(cfg["schema_registry_url"], cfg["schema_subject"])


def load_config(path: str) -> dict:
    """``{job: {trigger_interval, max_files_per_trigger, ...}}`` from YAML."""
    import yaml

    with open(path) as fh:
        return yaml.safe_load(fh) or {}


def _wait(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name!r} failed: {q.exception()}")


@dataclass
class Restarts:
    """How failed queries start again: ``starters`` by query name, each from
    its own checkpoint; at most ``limit`` times within ``window`` seconds,
    after ``delay`` seconds that double with each of these."""

    starters: dict[str, Callable[[], StreamingQuery]] = field(default_factory=dict)
    limit: int = 3
    delay: float = 10.0
    window: float = 3600.0
    _failures: dict[str, list[float]] = field(default_factory=dict)
    _due: dict[str, float] = field(default_factory=dict)

    def planned(self, name: str) -> bool:
        """Plan a start of the query that just failed, if it may have one."""
        now = time.monotonic()
        recent = [t for t in self._failures.get(name, []) if now - t < self.window]
        if name not in self.starters or len(recent) >= self.limit:
            return False
        self._failures[name] = [*recent, now]
        self._due[name] = now + self.delay * 2 ** len(recent)
        return True

    def start_due(self) -> list[StreamingQuery]:
        due = [n for n, at in self._due.items() if at <= time.monotonic()]
        for n in due:
            del self._due[n]
            log.warning("streaming query %s starts again", n)
        return [self.starters[n]() for n in due]

    def next_in(self, most: float) -> float:
        """Seconds until a start is due (``most`` if none is sooner)."""
        return max(0.1, min([most, *[at - time.monotonic() for at in self._due.values()]]))


def supervise(spark: SparkSession, queries: list[StreamingQuery], on_failure: str = "stop",
              records: L.LossRecords | None = None, every_seconds: int = 60, restarts: Restarts | None = None) -> None:
    """Block until the queries have ended.  A failed one is named at once
    (log) and in the error; with ``stop`` it takes the others with it, with
    ``continue`` they go on alone.  With ``restart`` it starts again as
    ``restarts`` allow while the others go on, and is given up (named in the
    error) beyond that."""
    failed: dict[str, str] = {}
    queries = list(queries)
    restarts = restarts if on_failure == "restart" and restarts else Restarts()
    while any(q.isActive for q in queries) or restarts._due:
        try:
            if any(q.isActive for q in queries):
                spark.streams.awaitAnyTermination(math.ceil(restarts.next_in(every_seconds)))
            else:
                time.sleep(restarts.next_in(every_seconds))
        except StreamingQueryException:
            pass  # looked up below, by query
        spark.streams.resetTerminated()
        for q in [q for q in queries if not q.isActive and q.exception() is not None and q.name not in failed]:
            why = str(q.exception()).split("\n")[0]
            log.error("streaming query %s failed: %s", q.name, why)
            if restarts.planned(q.name):
                queries.remove(q)
            else:
                failed[q.name] = why
        queries += restarts.start_due()
        if records:
            records.flush()
        if failed and on_failure == "stop":
            for q in queries:
                if q.isActive:
                    q.stop()
    if failed:
        raise RuntimeError("failed: " + "; ".join(f"{n!r}: {e}" for n, e in failed.items()))


def run_jobs(
    spark: SparkSession,
    lake: Lake,
    checkpoint_root: str,
    names: list[str] | None = None,
    topic: DataFrame | None = None,
    available_now: bool = False,
    config: dict | None = None,
    on_failure: str = "stop",
    losses: str | None = None,
) -> list[StreamingQuery]:
    """Start the named jobs (all by default); see the module doc for waiting.
    ``losses``: folder of the table that late drops and cast errors per
    micro-batch are recorded in."""
    records = L.LossRecords(LakeTable(spark, losses)) if losses else None
    if records:
        spark.streams.addListener(records)
    try:
        return _run(spark, lake, checkpoint_root, names, topic, available_now, config, on_failure, records)
    finally:
        if records:
            spark.streams.removeListener(records)
            records.flush()


def _run(spark, lake, checkpoint_root, names, topic, available_now, config, on_failure, records) -> list[StreamingQuery]:
    names = names or DEFAULT_JOBS
    for left, right in EXCLUSIVE:
        if left & set(names) and right & set(names):
            raise ValueError(f"jobs {sorted(left & set(names))} and {sorted(right & set(names))} write the same tables")
    config = config or {}
    restarts = Restarts()
    started: list[StreamingQuery] = []
    for layer in LAYER_ORDER:
        layer_queries: list[StreamingQuery] = []
        for name in [n for n in names if n.split(".", 1)[0] == layer]:
            cfg = config.get(name) or {}
            if unknown := set(cfg) - CONFIG_KEYS:
                raise ValueError(f"{name}: unknown settings {sorted(unknown)}")
            settings = P.StreamSettings(
                checkpoint=f"{checkpoint_root.rstrip('/')}/{name.replace('.', '/')}",
                trigger={"processingTime": cfg.get("trigger_interval", "1 minute")},
                max_files_per_trigger=cfg.get("max_files_per_trigger"),
                max_offsets_per_trigger=cfg.get("max_offsets_per_trigger"),
                shuffle_partitions=cfg.get("shuffle_partitions"),
                watermark=cfg.get("watermark", "2 days"),
                silver_mode=cfg.get("mode", "batch"),
                fact_mode=cfg.get("mode", "refresh"),
                offset_patience=cfg.get("offset_patience"),
                codec=cfg.get("codec", "json"),
                reader_schema=_reader_schema(cfg),
            )
            if available_now:
                settings = settings.available_now()
            start = partial(_in_pool, spark, name, partial(JOBS[name], spark, lake, settings, topic))
            queries = start()
            layer_queries += queries
            if len(queries) == 1:  # a bronze job with an offset guard stays stopped: lost offsets don't come back
                restarts.starters[queries[0].name] = lambda start=start: start()[0]
            if available_now and settings.offset_patience is not None and layer == "bronze":
                _wait(layer_queries)
                L.check_offsets(spark, _offset_state(settings))
        if available_now:
            _wait(layer_queries)
            _reported(spark, records, layer_queries)
        started += layer_queries
    if not available_now and started:
        supervise(spark, started, on_failure, records, restarts=restarts)
    return started


def _in_pool(spark: SparkSession, pool: str, start: Callable[[], list[StreamingQuery]]) -> list[StreamingQuery]:
    """Start queries whose jobs run in the scheduler pool ``pool`` (a share of
    the cores of its own where ``spark.scheduler.mode`` is FAIR)."""
    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.scheduler.pool")
    sc.setLocalProperty("spark.scheduler.pool", pool)
    try:
        return start()
    finally:
        sc.setLocalProperty("spark.scheduler.pool", before)


def _reported(spark: SparkSession, records: L.LossRecords | None, queries: list[StreamingQuery], seconds: float = 10) -> None:
    """Wait until the listener has seen the last progress of each query (the
    reports arrive a moment after it), then store them."""
    if not records:
        return
    last = {(str(q.runId), q.lastProgress["batchId"]) for q in queries if q.lastProgress}
    until = time.monotonic() + seconds
    while time.monotonic() < until and not last <= {(r[1], r[2]) for r in records.pending}:
        time.sleep(0.1)
    records.flush()


def main(argv: list[str] | None = None) -> None:
    """``python -m attrlake.streaming.runner --lake ROOT (--topic-path P | --kafka-servers S --kafka-topic T)``"""
    import argparse

    from attrlake.session import create_session, shared_dir

    ap = argparse.ArgumentParser(prog="python -m attrlake.streaming.runner")
    ap.add_argument("--lake", required=True, help="root folder of the lake tables, or the catalog name")
    ap.add_argument("--format", default="parquet", choices=["parquet", "iceberg"])
    ap.add_argument("--catalog-uri", help="Iceberg REST catalog URI (with --format iceberg)")
    ap.add_argument("--checkpoints", help="checkpoint root (default: <spark.checkpoint.dir>/streams)")
    ap.add_argument("--topic-path", help="file form of the topic (parquet of topic rows)")
    ap.add_argument("--kafka-servers")
    ap.add_argument("--kafka-topic")
    ap.add_argument("--codec", choices=["json", "avro"], help="payload codec of the topic")
    ap.add_argument("--schema-registry-url", help="registry that holds the topic's Avro schema")
    ap.add_argument("--schema-subject", help="default: <kafka topic>-value")
    ap.add_argument("--config", help="YAML: {job: {trigger_interval, max_files_per_trigger, ...}}")
    ap.add_argument("--jobs", nargs="*", help=f"subset of {sorted(JOBS)}")
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--on-failure", default="stop", choices=["stop", "continue", "restart"],
                    help="a failed query stops the others, leaves them running, or starts again (at most 3 times an hour)")
    ap.add_argument("--losses", help="folder of the table of late drops and cast errors per micro-batch")
    ap.add_argument("--keyed", default="deltas", choices=["deltas", "buckets"],
                    help="dimensions and current state: appended deltas folded on read, or rewritten hash buckets")
    ap.add_argument("--day-buckets", type=int, help="split silver's days into device buckets (fixed once silver holds rows)")
    ap.add_argument("--compact-every", type=int, default=64, help="deltas of a keyed table until it is compacted")
    ap.add_argument("--files-per-partition", type=int,
                    help="files per day and micro-batch in streaming writes (default: one per task)")
    args = ap.parse_args(argv)

    if args.format == "iceberg":
        spark = create_session("attrlake-jobs", catalog=args.lake, catalog_uri=args.catalog_uri)
    else:
        spark = create_session("attrlake-jobs")
    config = load_config(args.config) if args.config else {}
    bronze_cfg = dict(config.get("bronze.topic_to_bronze") or {})
    subject = args.schema_subject or (f"{args.kafka_topic}-value" if args.kafka_topic else None)
    for key, given in (("codec", args.codec), ("schema_registry_url", args.schema_registry_url), ("schema_subject", subject)):
        if given and not (key == "schema_subject" and key in bronze_cfg and not args.schema_subject):
            bronze_cfg[key] = given
    config["bronze.topic_to_bronze"] = bronze_cfg
    topic = None
    if args.kafka_servers and args.kafka_topic:
        topic = P.kafka_topic(spark, args.kafka_servers, args.kafka_topic,
                              bronze_cfg.get("max_offsets_per_trigger"), bronze_cfg.get("min_partitions"))
    elif args.topic_path:
        topic = P.file_topic(spark, args.topic_path, bronze_cfg.get("max_files_per_trigger"))
    checkpoints = args.checkpoints or f"{shared_dir(spark).rstrip('/')}/streams"
    lake = Lake(spark, args.lake, args.format, args.files_per_partition, keyed=args.keyed,
                day_buckets=args.day_buckets, compact_every=args.compact_every)
    run_jobs(spark, lake, checkpoints,
             names=args.jobs, topic=topic,
             available_now=args.available_now, config=config, on_failure=args.on_failure, losses=args.losses)


if __name__ == "__main__":
    main()
