"""The stages against a brute-force version of each on its own input."""

import duckdb
from test_packing import check_pieces
from test_similar_texts import brute_similar
from test_suffix_dedup import brute
from tokenizers import Tokenizer

import corpus_pipeline as C
from tendril.llm import packing
from tendril.llm.decontamination import OP9_SQL

DATA = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = C.table(spark, DATA, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    steps = dict(C.STAGES)
    known = C.written(steps["language_id"](spark, docs, DATA), "t")
    assert known.columns == docs.columns and {r.doc_id: r for r in known.collect()} == {i: r for i, r in rows.items() if any(map(str.isalpha, r.text))}

    single = C.written(steps["near_dedup"](spark, known, DATA), "t")
    component = brute_similar({i: r.text for i, r in rows.items()})
    assert {r.doc_id: r for r in single.collect()} == {i: rows[i] for i, c in component.items() if i == c}

    cut = C.written(steps["substring_dedup"](spark, single, DATA), "t")
    left = brute(sorted((r.doc_id, r.text) for r in single.collect()))
    want = {i: text for i, x in left.items() if (text := x[3].decode("utf-8", "ignore"))}
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns and {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) and r.lang == rows[i].lang for i, r in got.items())

    clean = C.written(steps["decontamination"](spark, cut, DATA), "t")
    con = duckdb.connect()
    cut.write.parquet(str(tmp_path / "cut"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/cut/*.parquet'; CREATE VIEW benchmark AS SELECT * FROM '{DATA}/benchmark.parquet'")
    leaked = {r[0] for r in con.execute(OP9_SQL).fetchall()}
    assert {r.doc_id: r for r in clean.collect()} == {i: r for i, r in got.items() if i not in leaked} and clean.columns == docs.columns

    exact = Tokenizer.from_file(packing.default_tokenizer())
    pieces = steps["packing"](spark, clean, DATA).collect()
    check_pieces(pieces, {r.doc_id: r.text for r in clean.collect()}, lambda x: exact.encode(x, add_special_tokens=False).ids)
    assert {r.doc_id for r in C.run(spark, DATA).select("doc_id").collect()} == {r.doc_id for r in clean.collect()}


def test_empty_and_odd_documents(spark, odd_docs, no_docs):
    for docs in (no_docs, odd_docs):
        for name, stage in C.STAGES[:-1]:
            columns = docs.columns
            docs = C.written(stage(spark, docs, DATA), name)
            assert docs.columns == columns
        assert C.STAGES[-1][1](spark, docs, DATA).count() >= docs.count()
