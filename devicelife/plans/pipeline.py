"""From report files to scored readings in one call.

Stages: ``features`` (files -> prepared rows), ``model`` (split, balance,
search, fit, evaluate -> committed bundle), ``scores`` (every feature row
scored with the saved model and its threshold). A stage's folder is named by
a hash of its settings and of what it reads: for the first one the files'
paths, sizes and modification times, for the others the stages before. A
stage is finished when its commit file exists, so a run that died goes on
after its last finished stage, and a changed setting or file redoes only
what depends on it.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicelife.plans import prep, training
from devicelife.operators import model
from devicelife.sources import bundle
from devicelife.sources.report import read_report


@dataclass
class PipelineConfig:
    device_key: str | None = "Serial Number"
    prep: prep.PrepConfig = field(default_factory=lambda: prep.PrepConfig(keys=("device",)))
    train: training.TrainConfig = field(default_factory=lambda: training.TrainConfig(keys=("device",)))


def files_digest(spark: SparkSession, paths: list[str]) -> str:
    """Hash of the files' names, sizes and times (their contents are not read)."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    got = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
    return f"{got.n}:{got.h}"


def stage_key(name: str, settings: dict, before: str) -> str:
    text = json.dumps([name, settings, before], sort_keys=True, default=str)
    return f"{name}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def run_pipeline(spark: SparkSession, paths: list[str], out_dir: str, cfg: PipelineConfig | None = None) -> DataFrame:
    """Rows with ``p_end`` and ``prediction_t``; folders of all stages lie under ``out_dir``."""
    cfg = cfg or PipelineConfig()
    paths = [paths] if isinstance(paths, str) else list(paths)
    folder = bundle.Folder(spark, out_dir)
    measure = cfg.prep.measures[0]

    def stage(name: str, settings: dict, before: str, work) -> str:
        key = stage_key(name, settings, before)
        if not folder.exists(f"done/{key}"):
            work(f"{out_dir}/{key}")
            folder.create(f"done/{key}")
        return key

    def features(at: str) -> None:
        report = read_report(spark, paths, device_key=cfg.device_key)
        prep.prepare_report(report, cfg.prep).write.mode("overwrite").parquet(at)

    def fit(at: str) -> None:
        df, feats = training.feature_table(spark.read.parquet(f"{out_dir}/{first}"), cfg.train, measure)
        training.run_training(df, feats, cfg.train, at)

    def score(at: str) -> None:
        fitted, meta = bundle.load_bundle(spark, f"{out_dir}/{second}")
        df, _ = training.feature_table(spark.read.parquet(f"{out_dir}/{first}"), cfg.train, measure)
        model.score(fitted, df, meta["prediction_threshold"]).write.mode("overwrite").parquet(at)

    first = stage("features", asdict(cfg.prep) | {"device_key": cfg.device_key}, files_digest(spark, paths), features)
    second = stage("model", asdict(cfg.train), first, fit)
    third = stage("scores", {}, second, score)
    return spark.read.parquet(f"{out_dir}/{third}")
