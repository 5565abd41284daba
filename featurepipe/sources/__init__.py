"""Readers and writers."""

from featurepipe.sources.csv import ORDER_COLS, csv_rejects, list_files, read_csv_tolerant, read_csv_union, read_header
from featurepipe.sources.json_relations import read_relation
from featurepipe.sources.published import publish_stage, stage_path
from featurepipe.sources.sinks import model_report, prediction_text, write_predictions, write_report
from featurepipe.sources.stages import read_stage, write_profile, write_stage

__all__ = ["ORDER_COLS", "csv_rejects", "list_files", "model_report", "prediction_text", "publish_stage", "read_csv_tolerant", "read_csv_union",
           "read_header", "read_relation", "read_stage", "stage_path", "write_predictions", "write_profile", "write_report",
           "write_stage"]
