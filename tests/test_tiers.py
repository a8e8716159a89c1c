"""Reports by customer tier: what is written on the way."""

from pyspark.sql import functions as F

from tables import SF001
from faresight.plans import catalog
from faresight.sources import binding
from faresight.sources.store import staged


def test_tiers_write_row_inputs_once_and_no_option_table(spark, monkeypatch):
    written = []
    for module in (catalog, __import__("faresight.operators.customers", fromlist=["x"])):
        monkeypatch.setattr(module, "staged", lambda df, name: written.append((name, len(df.columns))) or staged(df, name))
    assert catalog.q_rows_per_tier(spark, SF001).agg(F.sum("rows")).first()[0] == binding.candidates(spark, SF001).count()
    assert [name for name, _ in written].count("customer-rows") == 1 and max(n for _, n in written) < 60
