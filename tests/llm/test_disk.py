"""What the text operators send and leave on disk while they run."""

from lakeloom.llm import components, substrings


def test_op8_deals_its_texts_once(spark, docs_of, odd_rows):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    made = substrings.dedup_substrings(docs_of(odd_rows))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the answers; blocks lie by home already
    assert made.count() == len(odd_rows)
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive


def test_components_of_stars_take_no_round(spark, monkeypatch):
    made = []
    star = components._small_star
    monkeypatch.setattr(components, "_small_star", lambda edges: made.append(1) or star(edges))
    edges = [(i, i % 3) for i in range(3, 60)]
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == edges and not made
    chain = components.connected_components(spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")).collect()
    assert sorted(map(tuple, chain)) == [(i, 0) for i in range(1, 41)] and made
