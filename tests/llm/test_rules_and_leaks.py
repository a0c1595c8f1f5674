import math

import duckdb
import pytest

from tendril.llm import decontamination as D
from tendril.llm import quality_rules as Q

DATA = "/root/testdata/sf0.001"


def same(df, sql, tables):
    con = duckdb.connect()
    for name, source in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
    want = con.execute(sql)
    columns = [d[0] for d in want.description]
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_rules_equal_their_sql(spark):
    same(Q.op5_line_quality_rules(spark, DATA), Q.OP5_SQL, {"documents": f"{DATA}/documents.parquet"})


def test_rules_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    odd_docs.select("doc_id", "text").write.parquet(str(tmp_path / "d"))
    same(Q.clean_lines(odd_docs).drop("cleaned_text"), Q.OP5_SQL, {"documents": f"{tmp_path}/d/*.parquet"})
    assert Q.clean_lines(no_docs).count() == 0


def test_repeated_words_and_lines(spark):
    line = lambda k: " ".join(f"w{k}x{j}" for j in range(15)) + "."
    junk = "Home | News | Sport | More | Contact | About | Help | Login"
    rows = [(1, "\n".join(map(line, range(6)))), (2, "\n".join([f"{k} | {junk}" for k in range(8)] + [line(0)])), (3, "a b c a b c " * 30), (4, "\n".join([line(0), junk, line(0), *map(line, range(1, 8))]))]
    out = {r.doc_id: r for r in Q.clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].kept and out[1].n_repeat_words == 0 and not out[2].kept and out[3].base_failed and out[3].n_repeat_words == 180
    assert out[4].kept and out[4].n_dup_lines == 1 and out[4].n_repeat_words == 30
    assert junk not in out[4].cleaned_text and out[4].cleaned_text.count(line(0)) == 2 and out[4].chars_lost == len(junk)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_leaks_equal_their_sql(spark, sf):
    data = f"/root/testdata/{sf}"
    same(D.op9_benchmark_containment(spark, data), D.OP9_SQL, {t: f"{data}/{t}.parquet" for t in ("documents", "benchmark")})


def test_leaks_on_odd_documents(spark, odd_docs, no_docs, monkeypatch):
    item = " ".join(f"w{k}" for k in range(40))
    near = item.split()
    near[3] = "changed"  # breaks four of the 36 shingles at the start: 32/36 are left
    far = item.split()
    far[10] = far[20] = "changed"  # breaks ten: 26/36
    rows = [(100, "Before it. " + item.upper() + ", after it"), (101, " ".join(near)), (102, " ".join(far)), (103, None), (100, "x " + item), (104, "only three words"), (105, "Here are ONLY three words, and more of them than five."), (106, "only three other words"), (107, "capital")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    items = spark.createDataFrame([(1, item, 9), (2, None, 9), (3, "", 9), (4, "Only three, words!", 9), (None, "word1 and the other1. word2 and the", 9), (5, "Capital?", 9)], "item_id long, text string, h int")
    for broadcast in (200_000, 0):  # with and without broadcasts
        monkeypatch.setattr(D, "maybe_broadcast", lambda df, b=broadcast: D.F.broadcast(df) if b else df)
        out = sorted(((r.doc_id, r.item_id, r.n_found, r.n_shingles) for r in D.contained_items(docs, items).collect()), key=str)
        assert [x for x in out if x[1] is not None] == [(100, 1, 36, 36), (100, 1, 36, 36), (101, 1, 32, 36), (104, 4, 1, 1), (105, 4, 1, 1), (107, 5, 1, 1)]
        assert {x[0] for x in out if x[1] is None} == {4, 9}
    assert D.contained_items(no_docs, items).count() == 0 and D.contained_items(docs, items.limit(0)).count() == 0
    kept = D.without_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.where("doc_id in (4, 9)").isEmpty() and kept.where("doc_id is null").count() == 1


def test_short_items_equal_the_sql(spark):
    import duckdb

    docs = [(1, "so the capital of nowhere is"), (2, "the capital"), (3, "Of Nowhere"), (4, None), (5, "the of capital nowhere the capital of"), (6, "a b c d e f g")]
    items = [(1, "The capital of nowhere"), (2, "nowhere"), (3, "the capital of"), (4, "of nowhere!"), (5, None), (6, "..."), (7, "b c d e f")]
    got = D.contained_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    con = duckdb.connect()
    for name, column, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({column} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    want = sorted(con.execute(f"SELECT doc_id, item_id, n_shingles, n_found FROM ({D.OP9_SQL})").fetchall())
    assert sorted((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()) == want
    assert [x[:2] for x in want] == [(1, 1), (1, 2), (1, 3), (1, 4), (3, 2), (3, 4), (5, 2), (5, 3), (6, 7)]


def test_sketches_never_miss(spark):
    """An item's sketch is larger than what may be lacking."""
    rows = [(n, [f"t{n}_{k}" for k in range(n + 4)]) for n in (1, 2, 5, 8, 9, 31, 64, 100)]
    sizes = {r.item: r["count"] for r in D.sketches(spark.createDataFrame(rows, "item long, words array<string>")).groupBy("item").count().collect()}
    assert all(sizes[n] > n - math.ceil(0.8 * n) for n, _ in rows)


def test_rows_without_ids_and_ids_of_several_texts(spark):
    item = " ".join(f"w{k}" for k in range(20))
    rows = [(None, "x " + item), (None, "clean"), (3, item), (3, "clean too"), (4, "clean"), (4, "clean")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int")
    kept = D.without_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("3", "clean too"), ("4", "clean"), ("4", "clean"), ("None", "clean")]
