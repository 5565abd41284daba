"""featurepipe: a Spark-native feature pipeline for tabular data with text columns and
many-to-many relations.

Layers:
  functions/  Column -> Column expressions (sentinels, lenient numbers, accents, text flags)
  operators/  DataFrame -> DataFrame operators (cleaning, ordering, relations, features,
              statistics, gates, hooks, models)
  sources/    readers and writers (CSV shards, JSON relations, stage checkpoints, sinks)
  plans/      composites: silver, gold, build, train, stage comparison
  streaming/  the row-local cleaning stages on a streaming file source
"""

from featurepipe.config import PipelineConfig

__all__ = ["PipelineConfig"]
__version__ = "0.1.0"
