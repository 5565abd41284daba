"""CSV file stream -> row-local bronze/silver cleaning -> Parquet sink with a checkpoint."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from featurepipe.config import DEFAULT, PipelineConfig
from featurepipe.operators.features import add_word_count, flag_differs, flag_matches, flag_threshold
from featurepipe.plans.silver import bronze_clean, clean_values
from featurepipe.session import checkpoint_dir


def clean_stream(spark: SparkSession, src_dir: str, columns: list[str], cfg: PipelineConfig = DEFAULT,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of cleaned rows from CSV files (header, all strings) arriving in ``src_dir``."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    reader = spark.readStream.schema(schema).option("header", True).option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(src_dir)
    out = bronze_clean(raw, cfg)
    out = clean_values(out, cfg)
    out = flag_threshold(out, cfg.runtime, "is_long_film", ">", cfg.long_min)
    out = flag_threshold(out, cfg.start_year, "is_old_film", "<", cfg.old_year)
    out = flag_threshold(out, cfg.votes, "is_blockbuster", ">", cfg.blockbuster_votes)
    out = flag_differs(out, cfg.title, cfg.original_title, "is_foreign_title")
    out = add_word_count(out, cfg.title, "title_word_count")
    return flag_matches(out, cfg.title, "title_has_number")


def start_clean_stream(df: DataFrame, out_dir: str, name: str = "clean", available_now: bool = False,
                       ) -> StreamingQuery:
    """Append the cleaned rows as Parquet; progress is kept under the shared checkpoint folder so
    a restarted query resumes exactly once."""
    ckpt = os.path.join(checkpoint_dir(df.sparkSession), "featurepipe-streams", name)
    w = df.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(out_dir)
