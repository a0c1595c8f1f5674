"""Sources, normalization, trust, coverage, sinks and streams on hand-made rows."""

import json
import shutil
import unicodedata
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tendril.functions import text
from tendril.operators import buckets, coverage, normalize, profile, sinks, trust
from tendril.sources import artifact_store, files, pages
from tendril.streaming import intake


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_text_functions(spark):
    lit = F.lit
    assert one(spark, text.compact_text(lit("  x \t"))) == "x" and one(spark, text.compact_text(lit("  "))) is None
    assert one(spark, text.parse_date(lit("1.2.2020"))) == date(2020, 2, 1) and one(spark, text.parse_date(lit("31.02.2020"))) is None
    assert one(spark, text.parse_decimal(lit("350,000.00"))) == Decimal("350000.00") and one(spark, text.parse_decimal(lit("x"))) is None
    assert one(spark, text.parse_flag(lit(" PO "))) is True and one(spark, text.parse_flag(lit("?"))) is None
    assert one(spark, text.single_identifier(lit("l12345678a"))) == "L12345678A" and one(spark, text.single_identifier(lit("L12345678A K12345678B"))) is None
    assert one(spark, text.single_identifier(lit("ëL12345678A"))) is None
    assert one(spark, text.canonical_legal_form(lit("Shoqëri me Përgjegjësi të Kufizuar"))) == "SHPK" and one(spark, text.canonical_legal_form(lit("Degë e huaj"))) == "DEGE E HUAJ"
    assert one(spark, text.embedded_date(lit("dt 3/4/2021 x"))) == date(2021, 4, 3)
    assert [one(spark, text.embedded_date(lit(x))) for x in ("123.04.2020", "01.02.20201", "ë1.2.2020", "x 1.2.2020.", "123.04.2020 5-6-2021")] == [None, None, None, date(2020, 2, 1), date(2021, 6, 5)]
    assert one(spark, text.absolute_url(lit("https://a.al/x/y?z"), lit("b.pdf"))) == "https://a.al/x/b.pdf"
    assert one(spark, text.absolute_url(lit("https://a.al"), lit("//c.al/d"))) == "https://c.al/d"
    assert one(spark, text.storage_name(lit("h"), lit(".csv"), lit("a.b.pdf"))) == "a.b-h.pdf"


def test_export_csv_round_trip(spark, tmp_path):
    head = "Numri_i_references,NIPT_i_fituesit,Fondi_limit,Anulluar,Data_e_publikimit\n"
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + (head + 'R1,"L12345678A\nK12345678B","1,000.50",Po,01.02.2020\n\nR2,l12345678a\n').encode())
    rows = files.export_rows(spark, str(tmp_path))
    out = {r.row_ordinal: r for r in normalize.normalize_export(rows).collect()}
    assert out[1].winner_nipt is None and out[1].budget_limit_amount == Decimal("1000.50") and out[1].is_cancelled and out[1].publication_date == date(2020, 2, 1)
    assert out[2].winner_nipt == "L12345678A" and out[2].budget_limit_amount is None and out[2].source_payload["Anulluar"] == ""
    assert files.preview(rows, 1, 3).collect()[0].cells["Fondi_limit"] == "1,0"
    assert files.artifacts(spark, str(tmp_path)).count() == 1


def test_result_items_keep_ordinals(spark):
    rows = [(1, json.dumps({"response": [7, {"nipti": "K"}, {"nipti": "L"}]})), (2, json.dumps({"response": {"data": [{"nipti": "M"}]}})), (3, "{}"), (4, None)]
    out = normalize.normalize_registry(spark.createDataFrame(rows, "id long, payload string")).collect()
    assert sorted((r.id, r.result_ordinal, r.business_nipt) for r in out) == [(1, 2, "K"), (1, 3, "L"), (2, 1, "M")]


def test_embedded_json(spark):
    htmls = ['x response = JSON.parse("{\\"a\\": \\"\\\\u00eb\\"}") y', "response = JSON.parse('[1]')", "response = {\"a\": 2};", "nothing", "response = JSON.parse('{\"a\": \"x\\\\\"y \\u00eb it\\'s\"}')", "response = JSON.parse('{\"a\": 1}')"]
    out = spark.createDataFrame([(h,) for h in htmls], "html string").select(pages.embedded_json(F.col("html")).alias("j"))
    assert [r.j and json.loads(r.j) for r in out.collect()] == [{"a": "ë"}, [1], {"a": 2}, None, {"a": 'x"y ë it\'s'}, {"a": 1}]


def test_links_and_facets(spark):
    html = '<a href="/f.pdf"> Doc <b>1</b> 05.03.2021</a><a href="/f.pdf">again</a><a href="">x</a><a href="t">  </a>'
    df = spark.createDataFrame([(1, "https://a.al/l/", html)], "page_id long, url string, html string")
    assert [(r.href, r.title, r.published) for r in pages.links(df).collect()] == [("https://a.al/f.pdf", "Doc 1 05.03.2021", date(2021, 3, 5))]


def test_trust(spark):
    raw = spark.createDataFrame([(1, False, None), (2, True, None), (3, None, None)], "id long, is_corrupted boolean, corruption_reason string")
    rows = spark.createDataFrame([(None,), (1,), (2,), (3,), (9,)], "raw_fetch_id long")
    assert sorted(str(r[0]) for r in trust.trusted(rows, raw).collect()) == ["1", "None"]
    gate = {r.raw_fetch_id: (r.gate_status, r.gate_reason) for r in trust.snapshot_gate(rows, raw, "raw_fetch_id").collect()}
    assert gate[2] == ("corrupted", "raw fetch 2 is marked corrupted: unknown corruption reason") and gate[9][0] == "not_found" and gate[None][0] == "missing_id" and gate[3][0] == "ok"


def test_supersession_ignores_null_identity(spark):
    rows = [(1, ("A", "x", "y"), False), (2, ("A", "x", "y"), True), (3, None, False), (4, None, True), (5, ("B", "x", "y"), False)]
    df = spark.createDataFrame(rows, "id long, identity struct<legal_form:string,date_from:string,date_to:string>, chunked boolean")
    assert [r.id for r in trust.superseded(df).collect()] == [1]


def test_coverage(spark):
    windows = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 1, 3))], "k string, date_from date, date_to date")
    done = spark.createDataFrame([("a", date(2024, 1, 2), 50, True)], "k string, day date, n int, ok boolean")
    assert sorted(r.day.day for r in coverage.remaining_days(windows, done, "k").collect()) == [1, 3]
    r = coverage.run_summary(done, windows, "k").first()
    assert (r.days_requested, r.days_completed, r.days_truncated, r.days_remaining) == (3, 1, 1, 2)
    assert spark.range(1).select(coverage.local_day(F.lit("2024-01-01 23:30:00").cast("timestamp"))).first()[0] == date(2024, 1, 2)


def test_readiness_rules(spark):
    metrics = dict(award_rows=10, date_present_rate=0.95, registry_rows=3, award_entities=2, registry_entities=1, joined_entities=0, key_missing_rate=0.5, joinable_keys=0, registration_missing_rate=0.0)
    out = profile.findings(spark.range(1).select(*[F.lit(v).alias(k) for k, v in metrics.items()])).collect()
    assert {r.section for r in out} == {"strengths", "usable_feature_families_now", "weaknesses", "blockers", "priority_backfill_actions"}
    assert spark.range(1).select(profile.readiness(F.lit(0), F.lit(0.9))).first()[0] == "blocked"


def test_profiles_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b array<int>")
    assert {(r.field, r.total_rows, r.present_rate) for r in profile.field_profile(empty).collect()} == {("a", 0, 0.0), ("b", 0, 0.0)}


def test_replace_by_snapshot_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "rows")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "structured_record_id long, v string")
    sinks.replace_by_snapshot(a, path)
    for _ in range(2):
        sinks.replace_by_snapshot(a.where("v = 'x'").withColumn("v", F.lit("z")), path)
        assert sorted(r.v for r in buckets.current(spark, path).collect()) == ["y", "z"]
    sinks.replace_by_snapshot(a.where("false"), path, snapshots=spark.createDataFrame([(2,), (9,)], "structured_record_id long"))
    assert [r.v for r in buckets.current(spark, path).collect()] == ["z"]
    assert json.loads(sinks.as_json(a.orderBy("v")).first().json) == {"structured_record_id": 1, "v": "x"}


def files_below(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.parquet"))


def test_buckets_hold_many_snapshots_in_few_files(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id AS structured_record_id", "id % 3 AS v")
    sinks.replace_by_snapshot(rows, str(tmp_path / "rows"))
    assert len(files_below(tmp_path / "rows" / "data")) == buckets.BUCKETS
    sinks.replace_by_snapshot(rows.where("structured_record_id = 77").withColumn("v", F.lit(9).cast("long")), str(tmp_path / "rows"))
    assert len(files_below(tmp_path / "rows" / "data" / "version=1")) == 1
    assert buckets.current(spark, str(tmp_path / "rows")).groupBy("v").count().where("v = 9").first()["count"] == 1
    assert buckets.current(spark, str(tmp_path / "rows")).count() == 20_000


def test_a_version_that_is_written_again_or_has_no_manifest(spark, tmp_path):
    target, add = str(tmp_path / "t"), lambda old, new: new if old is None else old.select(*new.columns).union(new)
    put = lambda rows, version: buckets.change(spark.createDataFrame(rows, "k long, v string"), ["k"], target, add, version, 4)
    seen = lambda: sorted(tuple(r) for r in buckets.current(spark, target).select("k", "v").collect())
    put([(1, "a"), (2, "b")], 0)
    put([(1, "c")], 1)
    put([(1, "c")], 1)
    assert seen() == [(1, "a"), (1, "c"), (2, "b")]
    shutil.rmtree(tmp_path / "t" / "manifest" / "version=1")  # as if it had ended before its manifest
    assert seen() == [(1, "a"), (2, "b")]
    put([(1, "c")], 1)
    for k in range(2, 6):
        put([(1, f"v{k}")], k)
    assert len(seen()) == 7 and len(list((tmp_path / "t" / "manifest").iterdir())) == 2
    assert len(files_below(tmp_path / "t" / "data")) <= 4
    buckets.change(spark.createDataFrame([(1, ""), (2, "")], "k long, v string"), ["k"], target, lambda old, new: new.where("false"), 6, 4)
    assert buckets.current(spark, target) is None and buckets.current(spark, target, "k long, v string").count() == 0


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    whole = lambda i, key, day, payload: json.dumps({"id": i, "source_name": "s", "external_key": key, "fetched_at": f"2024-01-{day:02d}T00:00:00", "payload": payload})
    snap = lambda i, key, day, *names: whole(i, key, day, json.dumps({"response": [{"nipti": n} for n in names]}))
    (folder / "a.json").write_text("\n".join([snap(1, "k", 1, "A"), snap(2, "m", 2, "B"), snap(4, "n", 1, "D"), snap(5, "o", 1, "E1"), snap(5, "o", 2, "E2")]))
    rows, latest = str(tmp_path / "rows"), str(tmp_path / "latest")
    run = lambda: [q.awaitTermination() for q in (intake.normalized_intake(intake.snapshot_stream(spark, str(folder)), rows, str(tmp_path / "c1")), intake.latest_upkeep(intake.snapshot_stream(spark, str(folder)), latest, str(tmp_path / "c2")))]
    run()
    (folder / "b.json").write_text("\n".join([snap(3, "k", 3, "C"), snap(2, "m", 2, "B2", "B3"), snap(4, "n", 3), whole(1, "k", 2, "no json"), whole(6, "p", 1, '{"response": {"data": 5}}')]))
    run()
    assert sorted((r.structured_record_id, r.business_nipt) for r in intake.current_rows(spark, rows).collect()) == [(1, "A"), (2, "B2"), (2, "B3"), (3, "C"), (5, "E2")]
    found = {(r.batch, r.id): (r.outcome, r.reason, r.rows_inserted) for r in intake.outcomes(spark, rows).collect()}
    assert found[1, 4] == ("empty", None, 0) and found[1, 1] == ("failed", "payload is no JSON", 0) and found[1, 6] == ("failed", "payload has no list of results", 0) and found[1, 2] == ("ok", None, 2) and len(found) == 9
    assert sorted(r.id for r in intake.unfinished(spark, rows).collect()) == [1, 6]
    out = {r.external_key: r for r in intake.latest_rows(spark, latest).collect()}
    assert out["k"].id == 3 and out["k"].first_seen_at == datetime(2024, 1, 1) and out["k"].last_seen_at == datetime(2024, 1, 3) and out["m"].id == 2


def test_artifacts_are_written_once(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    at = datetime(2024, 1, 2)
    rows = [("s", "https://x/a", "k", "text/html", "detail.html", at, b"first"), ("s", "https://x/a", "k", "text/html", "detail.html", at, b"second"), ("s", "https://x/b", "k", "text/csv", None, at, b"first"), ("s", "https://x/c", "k", None, None, at, None), ("s", "u", "k", None, None, at, b"")]
    rows += [("s", f"https://x/{n}", "copies", "text/html", None, at, b"same") for n in range(200)]
    fetches = spark.createDataFrame(rows, "source_name string, source_url string, fetch_kind string, content_type string, filename string, fetched_at timestamp, content binary").repartition(4)
    (tmp_path / "store/s/2024/01/02/k").mkdir(parents=True)
    (tmp_path / "store/s/2024/01/02/k/.detail.half").write_bytes(b"fir")  # of a task that ended in between
    first, second = (artifact_store.store(fetches, root).collect() for _ in range(2))
    assert len(first) == 204 and any(r.was_written for r in first) and not any(r.was_written for r in second)
    assert sorted((r.storage_path, r.content_hash, r.stored_bytes) for r in first) == sorted((r.storage_path, r.content_hash, r.stored_bytes) for r in second)
    there = {r.path.partition("/store/")[2]: r.digest for r in files.artifacts(spark, root).collect()}
    assert there == {r.storage_path: r.content_hash for r in first if r.stored_bytes} and len(there) == 4
    assert [r.storage_path for r in first if not r.stored_bytes and (tmp_path / "store" / r.storage_path).exists()]


def test_artifacts_of_any_size(spark, tmp_path):
    """A file beyond two gigabytes, which no row could hold, one without bytes, and names that a URI would escape."""
    import hashlib

    size = 2_200_000_000
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    with open(second / "big.bin", "wb") as f:
        f.truncate(size)
    (first / "empty").write_bytes(b"")
    (second / "a b%20#ë.txt").write_bytes(b"odd")
    (first / "both").write_bytes(b"1"), (second / "both").write_bytes(b"2")
    (first / "folder").mkdir()
    want = hashlib.sha256()
    for _ in range(size // 1_100_000):
        want.update(bytes(1_100_000))
    of = lambda data: hashlib.sha256(data).hexdigest()
    rows = [(1, "big.bin", want.hexdigest()), (2, "empty", of(b"")), (3, "a b%20#ë.txt", of(b"odd")), (4, "both", of(b"1")), (5, f"{second}/both", of(b"1")), (6, "folder", "0"), (7, None, "0"), (8, "empty", "0"), (9, f"file://{second}/both", of(b"2"))]
    manifest = spark.createDataFrame(rows, "id long, storage_path string, content_hash string")
    got = {r.id: r for r in trust.stored_integrity(manifest, [f"file://{first}", f"file://{second}"]).collect()}
    assert {k: r.issue_type for k, r in got.items()} == {1: None, 2: None, 3: None, 4: None, 5: "content_hash_mismatch", 6: "missing_file", 7: "missing_file", 8: "content_hash_mismatch", 9: None}
    assert got[1].file_bytes == size and got[2].file_bytes == 0 and got[2].resolved_path == f"file://{first}/empty"
    listed = {r.length: r.digest for r in files.artifacts(spark, str(second)).collect()}
    assert listed == {size: want.hexdigest(), 3: of(b"odd"), 1: of(b"2")}
    assert trust.stored_integrity(manifest.limit(0), [f"file://{first}"]).count() == 0


def test_outcomes_by_raw_artifact(spark):
    raw = spark.createDataFrame([(1, False, None), (2, True, "cut")], "id long, is_corrupted boolean, corruption_reason string")
    payload = lambda ref: json.dumps({"raw_fetch_id": ref, "response": [{"nipti": "A"}]})
    rows = [(k, "s", "k", datetime(2024, 1, 1), p) for k, p in enumerate([payload(1), payload(2), payload(9), payload(None), None, '{"raw_fetch_id": 1, "response": [5, "x"]}'])]
    got = {r.id: (r.outcome, r.reason) for r in intake.snapshot_outcomes(spark.createDataFrame(rows, intake.SNAPSHOT), raw).collect()}
    assert {k: v[0] for k, v in got.items()} == {0: "ok", 1: "corrupted", 2: "failed", 3: "failed", 4: "failed", 5: "empty"} and got[1][1].endswith("cut")


def test_urls_resolve_as_in_the_standard(spark):
    from urllib.parse import urljoin

    bases = ["http://a/b/c/d;p?q", "http://a", "http://a/", "https://x.y/z/?k=1#f"]
    refs = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "./../g", "./g/.", "g/./h", "g/../h", "mailto:q", "g?y/../x"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "base string, ref string")
    out = df.select("base", "ref", text.absolute_url(F.col("base"), F.col("ref")).alias("full")).collect()
    assert {(r.base, r.ref): r.full for r in out} == {(b, r): urljoin(b, r) for b in bases for r in refs}


def test_reports_for_people(spark):
    from tendril.operators.sinks import as_json, materialized

    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert as_json(df, pretty=True).first()[0].splitlines() == ["{", '  "a" : 1,', '  "b" : null', "}"]
    now = materialized(df.union(df)).select("materialized_at").distinct().collect()
    assert len(now) == 1 and now[0][0].tzinfo is None


def test_accents_equal_nfkd(spark):
    chars = [chr(k) for k in range(1, 0x30000) if not 0xD800 <= k < 0xE000]
    texts = ["".join(chars[k : k + 100]) for k in range(0, len(chars), 100)] + [f"x{c}y" for c in chars[::7]] + ["", "Shoqëri ﬁ 한글 Ǆ…", None]
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.strip_accents(F.col("t")).alias("s"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r for r in out.collect() if r.s != (r.t if r.t is None else plain(r.t))] == []


def test_character_references(spark):
    for raw, want in {"a &amp; b": "a & b", "&#235;&#xeb;&#x1F600;": "ëë😀", "&nope; &amp &#0; &#xD800; &": "&nope; &amp &#0; &#xD800; &", "x&eacute;&NotEqualTilde;": "xé≂̸", "&amp;lt;": "&lt;"}.items():
        assert one(spark, text.unescaped(F.lit(raw))) == want


def test_anchors_of_all_kinds(spark):
    html = """<a href=x.pdf>A</a><a class="k" href="it's.pdf">B</a><a title="a > href='no'" href='/q?a=1&amp;b=2'>C &amp; D</a><!-- <a href="no.pdf">no</a> --><script>"<a href='no'>no</a>"</script>
    <a data-href="no" href = "y.doc">open<a HREF="z.docx"><i>E</i>F</a><a name="no">no</a><abbr href="no">no</abbr>"""
    df = spark.createDataFrame([(1, "https://a.al/l/", html), (2, "https://a.al", None)], "page_id int, url string, html string")
    assert [(r.href, r.text) for r in pages.links(df).orderBy("pos").collect()] == [("https://a.al/l/x.pdf", "A"), ("https://a.al/l/it's.pdf", "B"), ("https://a.al/q?a=1&b=2", "C & D"), ("https://a.al/l/y.doc", "open"), ("https://a.al/l/z.docx", "E F")]
    assert pages.facets(df.withColumn("page_id", F.lit("p")), ["f"]).schema["page_id"].dataType.simpleString() == "string"


def test_payloads_are_parsed_once(spark):
    df = spark.createDataFrame([(1, json.dumps({"nipt": " K ", "response": [{"nipti": "L", "showRedFlag": True, "qyteti": 3}]}))], "id long, payload string")
    out = normalize.normalize_registry(df)
    row = out.first()
    assert (row.search_nipt, row.business_nipt, row.has_red_flags, row.city) == ("K", "L", True, "3")
    assert "get_json_object" not in out._jdf.queryExecution().optimizedPlan().toString()
