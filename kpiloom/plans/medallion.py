"""End-to-end run of the monitoring DAG, each stage persisted (bronze -> silver -> gold).

Stages are coupled only through written tables, as in the monitored pipeline; every stage reads
the previous stage's files back, which cuts lineage (a lost executor never recomputes upstream
stages) and lets each stage be re-run on its own. Outputs go under a root folder that defaults to
the shared ``spark.checkpoint.dir`` of the cluster. Row counts come from write observations,
never from a second execution.

Order (from reads and writes):

    bronze(sheets) -> silver(internal, benchmark, rejects) -> gold(health, benchmark, signals)
                   -> analytics(priority scores, evidence edges) -> gold(board) -> gold(brief)
    silver -> quality (log + gate; nothing downstream reads the log)
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import SOCIAL_MEASURES, BoardConfig, BriefConfig, HealthConfig, PeerConfig, PriorityConfig, SignalConfig
from kpiloom.operators.board import priority_board
from kpiloom.operators.brief import brief_inputs
from kpiloom.operators.health import kpi_health
from kpiloom.operators.peers import peer_benchmark
from kpiloom.operators.priority import evidence_edges, scored_inputs
from kpiloom.operators.quality import QualityConfig, QualityGateError, quality_checks, quality_gate
from kpiloom.operators.signals import discover_signals
from kpiloom.operators.silver import BENCHMARK, INTERNAL, Sheet, SilverContract, normalize_benchmark, normalize_internal, silver_rejects, wide_sheet
from kpiloom.session import scratch_path
from kpiloom.sources.config_json import default_metric_dim, weights_from_json
from kpiloom.sources.sinks import write_table
from kpiloom.sources.tables import optional_source


@dataclass
class MedallionConfig:
    subject: str = "NATION_0"
    measures: tuple[str, ...] = ()     # instead of the contracts' own
    internal: SilverContract = INTERNAL
    benchmark: SilverContract = BENCHMARK
    extra_source: str | None = None    # optional peer source: table or path, used if it exists
    extra_subject: str | None = None
    extra_asset: str = "social_media"
    extra_measures: tuple[str, ...] = SOCIAL_MEASURES
    weights_path: str | None = None    # scoring weights as JSON, instead of the board's
    candidates: tuple = ()
    targets: tuple = ()
    health: HealthConfig = field(default_factory=HealthConfig)
    peers: PeerConfig = field(default_factory=PeerConfig)
    signals: SignalConfig = field(default_factory=SignalConfig)
    priority: PriorityConfig = field(default_factory=PriorityConfig)
    board: BoardConfig = field(default_factory=BoardConfig)
    brief: BriefConfig = field(default_factory=BriefConfig)
    quality: QualityConfig = field(default_factory=QualityConfig)
    fail_on_quality: bool = True       # a failed required check stops the run before gold
    fmt: str = "parquet"
    partition_by_month: bool = False   # month folders on the facts and health: month filters prune files


@dataclass
class StageResult:
    name: str
    path: str
    rows: int
    seconds: float


class Medallion:
    """Runs the stages, writing each under ``root``; ``results`` keeps rows and timings."""

    def __init__(self, spark: SparkSession, root: str | None = None, fmt: str = "parquet"):
        self.spark = spark
        self.root = (root or scratch_path(spark, "medallion")).rstrip("/")
        self.fmt = fmt
        self.results: list[StageResult] = []
        self.quality_error: str | None = None

    def persist(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.root}/{name}"
        t0 = time.time()
        rows = write_table(df, path, fmt=self.fmt, partition_by=partition_by)
        self.results.append(StageResult(name, path, rows, time.time() - t0))
        return self.spark.read.format(self.fmt).load(path)

    def run(self, wide: DataFrame, metric_dim: DataFrame | None, cfg: MedallionConfig) -> dict[str, DataFrame]:
        """All stages from one wide sheet of all clubs and assets; the subject's rows are the internal ones."""
        bronze = self.persist("bronze_wide", wide)
        is_subject = F.col("club") == cfg.subject
        out = self.run_silver([Sheet(bronze.filter(is_subject))], [Sheet(bronze.filter(~is_subject))], metric_dim, cfg)
        return {"bronze": bronze, **out}

    def run_sheets(self, internal: Sequence[Sheet], benchmark: Sequence[Sheet], metric_dim: DataFrame | None,
                   cfg: MedallionConfig) -> dict[str, DataFrame]:
        """All stages from one raw sheet per asset and side; each is kept as delivered, and as a typed wide table."""
        landed = {}
        for side, sheets, contract in (("internal", internal, cfg.internal), ("benchmark", benchmark, cfg.benchmark)):
            landed[side] = [replace(s, rows=self.persist(f"bronze_{side}_{s.asset_name or i}", s.rows)) for i, s in enumerate(sheets)]
            if side == "internal":
                for s in landed[side]:
                    self.persist(f"silver_internal_{s.asset_name}", wide_sheet(s, contract))
        return self.run_silver(landed["internal"], landed["benchmark"], metric_dim, cfg)

    def run_silver(self, internal_sheets: Sequence[Sheet], benchmark_sheets: Sequence[Sheet], metric_dim: DataFrame | None,
                   cfg: MedallionConfig) -> dict[str, DataFrame]:
        """Silver facts and rejects from the sheets, then quality and gold. No dimension: the shipped dictionary."""
        by_month = ("month",) if cfg.partition_by_month else ()
        metric_dim = default_metric_dim(self.spark) if metric_dim is None else metric_dim
        own = {"measures": cfg.measures} if cfg.measures else {}
        one, two = replace(cfg.internal, **own), replace(cfg.benchmark, **own)
        internal = self.persist("silver_internal", normalize_internal(internal_sheets, one), by_month)
        benchmark = self.persist("silver_benchmark", normalize_benchmark(benchmark_sheets, two), by_month)
        rejects = self.persist("silver_rejects", silver_rejects(internal_sheets, one).unionByName(silver_rejects(benchmark_sheets, two)))

        t0 = time.time()
        try:
            checks = quality_checks(internal, benchmark, run_id=f"run-{uuid.uuid4()}", cfg=cfg.quality)
            quality_gate(checks, f"{self.root}/quality_log", self.fmt)
        except QualityGateError as e:
            self.quality_error = str(e)
            if cfg.fail_on_quality:
                raise
        self.results.append(StageResult("quality", f"{self.root}/quality_log", -1, time.time() - t0))

        health = self.persist("gold_kpi_health", kpi_health(internal, metric_dim, cfg.health), by_month)
        peers = benchmark.select("month", "asset_name", "metric_name",
                                 F.col("metric_value").alias("peer_value"), "club")
        extra = optional_source(self.spark, cfg.extra_source)
        bench = self.persist("gold_peer_benchmark", peer_benchmark(
            internal, peers, metric_dim, extra, cfg.extra_subject or cfg.subject, cfg.extra_asset, cfg.extra_measures, cfg.peers))
        signals = self.persist("gold_signal_relationships",
                               discover_signals(internal, cfg.candidates, cfg.targets, cfg.signals))
        scores = self.persist("gold_priority_scores", scored_inputs(health, bench, signals, metric_dim, cfg.priority))
        evidence = self.persist("gold_priority_evidence", evidence_edges(scores))
        board_cfg = cfg.board if cfg.weights_path is None else replace(cfg.board, weights=weights_from_json(self.spark, cfg.weights_path))
        board = self.persist("gold_priority_board", priority_board(scores, board_cfg, signals, evidence))
        brief = self.persist("gold_monthly_brief_inputs", brief_inputs(board, health, bench, signals, cfg.brief))
        return {"internal": internal, "benchmark": benchmark, "rejects": rejects, "health": health, "bench": bench,
                "signals": signals, "scores": scores, "evidence": evidence, "board": board, "brief": brief}
