"""What the driver holds for the similarity join: few jobs, plans of bounded size, no filters left over."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import jaccard_join
from siltstone.llm.jaccard_join import jaccard_components
from siltstone.llm.shared import FILTER_BITS, bitmap_of, in_bitmap


@pytest.fixture
def jobs_of(spark):
    """The jobs that a call runs."""
    context = spark.sparkContext

    def count(call, group):
        context.setJobGroup(group, group)
        try:
            return call(), len(context.statusTracker().getJobIdsForGroup(group))
        finally:
            for key in ("spark.jobGroup.id", "spark.job.description"):
                context.setLocalProperty(key, None)

    return count


def test_a_filter_is_fetched_by_one_job_whatever_the_partitions(spark, conf, jobs_of):
    conf(spark__sql__shuffle__partitions="40", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(3000).select((F.col("id") * 977).alias("value"))
    whole, jobs = jobs_of(lambda: bitmap_of(rows, "value"), "filter")
    assert jobs <= 4
    bits = rows.select(F.pmod(F.xxhash64("value"), F.lit(FILTER_BITS)).alias("bit")).toPandas()["bit"].to_numpy()
    assert in_bitmap(whole, bits).all()
    assert np.unpackbits(whole).sum() == len(np.unique(bits))
    assert not bitmap_of(rows.where("value < 0"), "value").any()


def test_written_steps_have_plans_of_bounded_size(spark, monkeypatch):
    exchanges = {}

    def seen(write):
        def wrapped(df, label, *rest, **options):
            plan = df._jdf.queryExecution().executedPlan().toString()
            exchanges[label] = max(exchanges.get(label, 0), plan.count("Exchange "))
            return write(df, label, *rest, **options)

        return wrapped

    monkeypatch.setattr(jaccard_join, "stage", seen(jaccard_join.stage))
    monkeypatch.setattr(jaccard_join, "staged", seen(jaccard_join.staged))
    words = [f"w{n}" for n in range(60)]
    texts = [" ".join([*words[:n % 50], f"x{n}", *words[n % 50 :]]) for n in range(80)] + ["", "one two"]
    found = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert found.count() == len(texts)
    assert exchanges["chunks"] and max(exchanges.values()) <= 16
