"""faresight: choice ranking and customer segmentation on Spark.

Input is one row per option shown in a search session (``ranker_id``) to a
customer (``profileId``), with a ``selected`` label.  Every stage is a
DataFrame / Spark SQL / Spark ML job:

* ``sources``    – reading tables, the option-level ``candidates`` binding,
                   stage store (parquet between stages, fitted artefacts).
* ``functions``  – column-expression builders (duration parsing, horizontal
                   min/max/mean, null-preserving clip, guarded correlation …).
* ``operators``  – profiling, session split, customer / option features,
                   combine, metrics, segmentation and ranking algorithms.
* ``plans``      – the registered query catalogue and its DuckDB oracle SQL.
* ``streaming``  – empty: the reference has no streaming workload.
"""

from faresight.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
