"""Queries deal their rows by number before they tell values apart."""

from florispark.plans import domain, surface

SF = "/root/testdata/sf0.001"


def test_stated_facts_deal_each_large_table_before_they_count_its_values(spark, monkeypatch):
    """No task holds the distinct values of a whole split: every table's rows, or a bound on them, are told to dealt() with a key."""
    seen = []

    def dealt(df, rows, *keys, **more):
        assert rows >= df.count() > 0
        seen.append(keys)
        return df.repartition(7, *keys)

    want = {r.fact: r.value for r in surface.stated_facts(spark, SF).collect()}
    monkeypatch.setattr(surface, "dealt", dealt)
    monkeypatch.setattr(domain, "dealt", dealt)
    assert {r.fact: r.value for r in surface.stated_facts(spark, SF).collect()} == want
    assert {("name",), ("o_custkey",), ("l_orderkey",), ("compound",), ("species",), ("ref_no",)} <= set(seen)
