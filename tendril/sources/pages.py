"""Jobs over saved pages: links, index rows, embedded JSON, document actions, facets, contracts."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tendril.functions.text import absolute_url, embedded_date, strip, unescaped

TITLE, TEXT = 500, 4000
# Patterns of links, assignments and contracts.
QUOTED = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"  # inside of a tag: quoted values may hold >
ANCHOR = rf"(?is)<a(?=\s)({QUOTED})>(.*?)(?=</a\s*>|<a[\s>]|\Z)"
ATTRIBUTE = r"([^\s=/>\"']+)\s*=\s*(\"[^\"]*+\"|'[^']*+'|[^\s>\"']+)"
TAG = rf"<{QUOTED}>|<[^>]*>"
UNSEEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
DOCUMENT_LINK = r"(?i)\.(pdf|docx?|xlsx?)($|\?)"
DATA_DOC = r"(?i)data-doc\s*=\s*[\"']([^\"']*)[\"']"
FULL_URL = r"\bfullUrl\s*=\s*(?:'([^']*)'|\"([^\"]*)\")"
PARSE_DOUBLE = r"response\s*=\s*JSON\.parse\s*\(\s*\"((?:\\.|[^\"\\])*)\"\s*\)"
PARSE_SINGLE = r"response\s*=\s*JSON\.parse\s*\(\s*'((?:\\.|[^'\\])*)'\s*\)"
DIRECT = r"response\s*=\s*(\{[\s\S]*?\}|\[[\s\S]*?\])\s*;"
DOWNLOAD_HINT = "GetData/ExportDocument?year="


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: tags dropped, character references decoded, white space squeezed."""
    return strip(F.regexp_replace(unescaped(F.regexp_replace(markup, TAG, " ")), r"(?U)\s+", " "))


def attribute(inside: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, with or without quotes, references decoded; null if there is none."""
    pairs = F.arrays_zip(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(1)).alias("n"), F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(2)).alias("v"))
    raw = F.get(F.filter(pairs, lambda x: F.lower(x["n"]) == name), F.lit(0))["v"]
    return unescaped(F.when(raw.rlike("^[\"']"), F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw))


def links(pages: DataFrame, documents_only: bool = False) -> DataFrame:
    """pages (page_id, url, html) -> page_id, pos, href (absolute), title, text, published: the first of each href. An
    anchor ends where it is closed or the next one begins; those in comments and scripts don't count."""
    seen = pages.select("page_id", "url", F.regexp_replace("html", UNSEEN, " ").alias("html"))
    anchors = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("inside"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("t"))
    read = F.transform(anchors, lambda x: F.struct(attribute(x["inside"], "href").alias("h"), x["t"].alias("t")))
    found = seen.select("page_id", "url", F.posexplode(F.filter(read, lambda x: x["h"].isNotNull())).alias("pos", "x"))
    own = found.select("page_id", "pos", "url", strip(F.col("x.h")).alias("raw"), plain_text(F.col("x.t")).alias("text")).where("raw <> ''")
    full = own.withColumn("href", absolute_url(F.coalesce("url", F.lit("")), F.col("raw")))
    is_doc = F.col("href").rlike(DOCUMENT_LINK) | F.lower("href").contains("download")
    kept = full.where(is_doc if documents_only else is_doc | (F.col("text") != ""))
    title = F.when(F.col("text") != "", F.col("text")).otherwise(F.element_at(F.split("href", "/"), -1))
    first = kept.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "href").orderBy("pos"))).where("nth = 1")
    return first.select("page_id", "pos", "href", F.substring(title, 1, TITLE).alias("title"), F.substring("text", 1, TEXT).alias("text"), embedded_date(F.col("text")).alias("published"))


def export_index(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) -> page_id, year, filename: table rows (year, *.csv), or lines of text if there are none;
    of a year's files the last."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("pos", "row"))
    cells = rows.select("page_id", "pos", F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), plain_text).alias("c")).where("size(c) >= 2")
    table = cells.where(F.col("c")[0].rlike(r"^20\d{2}$") & F.lower(F.col("c")[1]).endswith(".csv")).select("page_id", "pos", F.col("c")[0].cast("int").alias("year"), F.col("c")[1].alias("filename"))
    lines = pages.join(table.select("page_id").distinct(), "page_id", "left_anti").select("page_id", F.posexplode(F.split(F.regexp_replace("html", "<[^>]*>", "\n"), "\n")).alias("pos", "l"))
    text = lines.select("page_id", "pos", strip(F.col("l")).alias("l")).where(F.col("l").rlike(r"^(20\d{2})\s+(.+\.csv)$"))
    text = text.select("page_id", "pos", F.regexp_extract("l", r"^(20\d{2})\s+", 1).cast("int").alias("year"), F.regexp_extract("l", r"^20\d{2}\s+(.+\.csv)$", 1).alias("filename"))
    return table.union(text).groupBy("page_id", "year").agg(F.max_by("filename", "pos").alias("filename"))


def embedded_json(html: Column) -> Column:
    """The JSON text that a page assigns to `response`, as it is or through JSON.parse of a quoted text, whose escapes are
    resolved; null where there is none. In single quotes, plain double quotes are the text's own."""
    single = F.replace(F.regexp_extract(html, PARSE_SINGLE, 1), F.lit("\\'"), F.lit("'"))
    single = F.regexp_replace(single, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')
    quoted = F.coalesce(F.nullif(F.regexp_extract(html, PARSE_DOUBLE, 1), F.lit("")), F.nullif(single, F.lit("")))
    unescaped = F.get(F.from_json(F.concat(F.lit('["'), quoted, F.lit('"]')), "array<string>"), F.lit(0))
    return F.coalesce(unescaped, F.nullif(F.regexp_extract(html, DIRECT, 1), F.lit("")))


def action_evidence(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) -> document types in order, whether two handlers are called, and the last full url."""
    types = F.array_distinct(F.filter(F.transform(F.regexp_extract_all("html", F.lit(DATA_DOC), F.lit(1)), strip), lambda x: x != ""))
    urls = F.zip_with(F.regexp_extract_all("html", F.lit(FULL_URL), F.lit(1)), F.regexp_extract_all("html", F.lit(FULL_URL), F.lit(2)), lambda a, b: strip(F.concat(a, b)))
    return pages.select("page_id", types.alias("document_types"), F.col("html").rlike(r"\bfetchAndDisplayPDF\s*\(").alias("displays_pdf"), F.col("html").rlike(r"\bdownloadButtonPress\s*\(").alias("downloads"), F.try_element_at(F.filter(urls, lambda u: u != ""), F.lit(-1)).alias("full_url"))


def search_contract(pages: DataFrame, fields: dict[str, str]) -> DataFrame:
    """pages (page_id, html), fields name -> id -> form count and what the page lacks of a search form."""
    forms = F.size(F.regexp_extract_all("html", F.lit(r"(?i)<form\b"), F.lit(0)))
    submit = F.col("html").rlike(r"(?i)<button\b") | F.col("html").rlike(r"(?i)<input\b[^>]*type\s*=\s*[\"']submit")
    lacks = [F.when(forms == 0, "search form"), *[F.when(~F.col("html").rlike(rf"(?i)\bid\s*=\s*[\"']{i}[\"']"), f"{name} selector '#{i}'") for name, i in fields.items()], F.when(~submit, "submit control")]
    return pages.select("page_id", forms.cast("long").alias("form_count"), F.array_compact(F.array(*lacks)).alias("missing"))


def index_contract(pages: DataFrame) -> DataFrame:
    """pages (page_id, html) -> years parsed, first and last year, whether the download hint is there, what's missing."""
    years = export_index(pages).groupBy("page_id").agg(F.count(F.lit(1)).alias("year_count"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    hint = F.col("html").contains(DOWNLOAD_HINT)
    return pages.select("page_id", hint.alias("download_hint")).join(years, "page_id", "left").fillna(0, ["year_count"]).withColumn("missing", F.array_compact(F.array(F.when(F.col("year_count") == 0, "export years"), F.when(~F.col("download_hint"), "download hint"))))


class _Options(HTMLParser):
    def __init__(self, fields):
        super().__init__()
        self.fields, self.field, self.value, self.label, self.rows = set(fields), None, None, [], []

    def _close(self):
        if self.field and self.value is not None:
            label = " ".join("".join(self.label).split())
            if self.value.strip():
                self.rows.append((self.field, self.value.strip(), label or self.value.strip()))
        self.value, self.label = None, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "select":
            self._close()
            self.field = a.get("name") if a.get("name") in self.fields else None
        elif tag == "option" and self.field:
            self._close()
            self.value = a.get("value") or ""

    def handle_endtag(self, tag):
        if tag in ("option", "select"):
            self._close()
        if tag == "select":
            self.field = None

    def handle_data(self, data):
        if self.value is not None:
            self.label.append(data)


def facets(pages: DataFrame, fields: list[str]) -> DataFrame:
    """pages (page_id, html) -> page_id, field, pos, value, label of the options of the named selects: the first of
    each value, fields in the given order."""
    rank = {f: k for k, f in enumerate(fields)}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for page, html in zip(frame["page_id"], frame["html"], strict=True):
                parser = _Options(fields)
                parser.feed(html or "")
                parser.close()
                rows += [(page, rank[f], f, k, v, label) for k, (f, v, label) in enumerate(parser.rows)]
            yield pd.DataFrame(rows, columns=["page_id", "rank", "field", "pos", "value", "label"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    found = pages.select("page_id", "html").mapInPandas(run, f"page_id {id_type}, rank int, field string, pos int, value string, label string")
    return found.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "field", "value").orderBy("pos"))).where("nth = 1").drop("nth")


def document_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Adds status, state, message, error, pdf bytes, size and prefix to backend responses (JSON texts)."""
    j = lambda k: F.get_json_object(body, f"$.{k}")
    obj = F.coalesce(F.schema_of_variant(F.try_parse_json(body)).startswith("OBJECT"), F.lit(False))
    status = F.when(obj, j("status").try_cast("int"))
    message = lambda *keys: F.coalesce(*[F.nullif(strip(j(k)), F.lit("")) for k in keys])
    packed = F.regexp_replace(F.coalesce(j("data"), F.lit("")), r"\s+", "")
    sound = packed.rlike(r"^[A-Za-z0-9+/]*={0,2}$") & (F.length(packed) % 4 == 0)
    pdf = F.when((status > 0) & sound, F.try_to_binary(packed, F.lit("base64")))
    is_pdf = F.coalesce(F.startswith(F.hex(pdf), F.lit("25504446")), F.lit(False))
    state = F.when(status == 0, "not_found").when(status < 0, "server_error").when(is_pdf, "success")
    error = F.when(~obj, "body is not a JSON object").when(status.isNull(), "status is not numeric").when((status > 0) & (packed == ""), "data is missing").when((status > 0) & pdf.isNull(), "data is not base64").when((status > 0) & ~is_pdf, "data is not a PDF")
    return responses.withColumns({
        "backend_status": status, "backend_state": state, "message": F.when(status <= 0, message("message", "error", "data")).when(status > 0, message("message", "error")), "error": error,
        "pdf": F.when(is_pdf, pdf), "pdf_size": F.when(is_pdf, F.octet_length(pdf)).cast("long"), "prefix": F.when(is_pdf, F.substring(packed, 1, 16)),
    })
