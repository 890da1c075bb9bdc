import duckdb
import pytest

from sunset_engine.llm import url_filter as U

SCHEMA = "page_id long, url string, host string, rule string, uid int"


def test_rules_and_parts(spark):
    rows = [(1, "http://A.Example.ORG/es/x?q", "a.example.org", "/es/x", "example.org/es/", "block"), (2, "https://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
            (3, "x://y.org/", "y.org", "/", "org/", "allow"), (4, "x://y.org", "y.org", "", None, None), (5, "x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
            (6, "x://c.com/fr/a", "c.com", "/fr/a", "com/fr/", "allow"), (7, "x://c.com/de/a", "c.com", "/de/a", "com/de/", "block"), (8, "x://c.com?/fr/", "c.com", "", None, None),
            (9, "no scheme.org/", "", "", None, None), (10, None, "", "", None, None), (11, "", "", "", None, None), (12, "x://É.ORG/a?b#c", "É.org", "/a", "org/", "allow"), (13, "x://", "", "", None, None),
            (None, "x://y.org/", "y.org", "/", "org/", "allow"), (3, "x://y.org/", "y.org", "/", "org/", "allow")]
    df = spark.createDataFrame([(p, u, "h", "r", 1) for p, u, *_ in rows], SCHEMA)
    got = U.filter_urls(df).collect()
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in got) == sorted((str(r[0]), r[2], r[3], str(r[4])) for r in rows)
    verdict = {r.page_id: r.verdict for r in got}
    assert all(verdict[r[0]] == r[5] for r in rows if r[5]) and verdict[10] == verdict[11] == "allow"
    assert all((r.score is None) == (r.rule is not None or r.page_id in (10, 11)) for r in got if r.page_id is not None)


def test_empty_table_and_no_rules(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert U.filter_urls(none).collect() == []
    one = spark.createDataFrame([(1, "x://a.net/b", "", "", 0)], SCHEMA)
    assert [r.verdict for r in U.filter_urls(one).collect()] == ["allow"]


def test_models_tell_kinds_apart(spark):
    """Unruled URLs follow the language of the rule-decided ones."""
    rows = [(i, f"http://h{i % 7}.com/{'fr' if i % 2 else 'de'}/{'bon' if i % 2 else 'gut'}{i % 13}") for i in range(400)]
    rows += [(1000 + i, f"http://h{i}.net/{'fr' if i % 2 else 'de'}/{'bon' if i % 2 else 'gut'}{i}") for i in range(60)]
    got = U.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).where("page_id >= 1000").collect()
    assert all(r.verdict == ("allow" if r.page_id % 2 else "block") for r in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    got = {tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in U.op9_url_model_ratio(spark, d).collect()}
    with duckdb.connect() as c:
        c.execute(f"create view pages as select * from '{d}/pages.parquet'")
        assert got == set(c.execute(f"select page_id, host, path, rule, verdict from ({U.oracle()})").fetchall())


def test_very_long_urls(spark):
    rows = [(1, "http://a.org/" + "x/" * 20_000), (2, "http://b.com/de/" + "y" * 9_000), (3, "http://c.net/" + "z?" * 10_000), (4, "http://d.org/a"), (5, "http://e.com/de/b")]
    got = {r.page_id: r.verdict for r in U.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1] == "allow" and got[2] == "block" and set(got) == {1, 2, 3, 4, 5}
