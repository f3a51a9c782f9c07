"""The entry module where the optional subpackage cannot be imported, and drawn keys."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brindle.sources import generate

ROOT = str(Path(__file__).resolve().parents[1])


@pytest.mark.parametrize("absent", ["brindle.llm", "public_tokenizers", "regex", "tiktoken", "corpus_pipeline"])
def test_the_other_queries_stand_without_it(absent):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
sys.modules[{absent!r}] = None
import __spark_entry__ as entry
from brindle.plans import QUERIES
assert set(QUERIES) <= set(entry.queries()) and "pipeline" not in entry.queries()
assert set(entry.oracle_sql()) <= set(entry.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_alias_table_gives_each_class_its_share():
    shares = [0.5, 0.1, 0.05, 0.35]
    table = generate.alias_table(shares)
    found = [0.0] * 4
    for i, (stays, other) in enumerate(table):
        found[i] += stays / 4
        found[other] += (1 - stays) / 4
    assert found == pytest.approx(shares)


def test_keys_are_drawn_from_a_table_with_gaps(spark):
    keys = spark.createDataFrame([(k,) for k in [5, 7, 1000, 10**12, 13, 13]], "k bigint")
    ids = spark.range(20_000)
    drawn = generate.draw_keys(ids, keys, "k", "user", {7: 0.5, 13: 0.1})
    counts = {r["user"]: r["count"] for r in drawn.groupBy("user").count().collect()}
    assert set(counts) == {5, 7, 13, 1000, 10**12} and sum(counts.values()) == 20_000
    expected = {7: 10_000, 13: 2_000, 5: 8_000 / 3, 1000: 8_000 / 3, 10**12: 8_000 / 3}
    assert all(abs(counts[k] - n) < 6 * n**0.5 for k, n in expected.items())
    again = generate.draw_keys(ids.repartition(3), keys, "k", "user", {7: 0.5, 13: 0.1})
    assert drawn.exceptAll(again).isEmpty()
    assert generate.draw_keys(ids, keys, "k", "user").filter(F.col("user").isNull()).isEmpty()
    with pytest.raises(ValueError, match="add up"):
        generate.draw_keys(ids, keys, "k", "user", {5: 0.7, 7: 0.7})
