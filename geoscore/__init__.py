"""geoscore: location analytics on Spark.

Feature tables from star joins and entity-attribute-value data, grid
location and spatial joins, tree-ensemble tuning / evaluation / stacking,
residual-based opportunity scores and distributed Shapley attribution,
all expressed as DataFrame transformations and Spark ML pipelines.

Sub-packages:
  functions/  column expressions (ratios, recodes, caps, scores, geometry)
  operators/  DataFrame operators (EAV widening, ranking, spatial joins,
              scoring, metrics, model tuning, attribution)
  sources/    table scans and sinks (append, slice replace, keyed update,
              run registry, status log, artifacts)
  plans/      user-level jobs and the registered stand-in queries
  streaming/  micro-batch adapters for the append-only sinks
"""

from geoscore.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
