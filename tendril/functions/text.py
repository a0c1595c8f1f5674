"""Scalar cleaning functions: Column in, Column out. All stay inside the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag words, document types and reasons.
TRUE_WORDS = ("po", "yes", "true")
FALSE_WORDS = ("jo", "no", "false")
DAY_FIRST = r"^(\d{1,2})([./])(\d{1,2})\2(\d{4})$"
IDENTIFIER = r"(?iU)\b[A-Z][0-9]{8}[A-Z]\b"
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
REFERENCE = "^&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
HANGUL = 0xAC00  # the first Korean syllable: 19 leads of 21 vowels of 28 tails each, the first tail being none
CORRUPTION_REASONS = {
    "content_hash_mismatch": "content_hash mismatch",
    "missing_file": "missing file",
}
DOCUMENT_KINDS = {"simple": "simple_extract_pdf", "historical": "historical_extract_pdf", "rpp": "rpp_pdf"}
SHPK_LONG, SHA_LONG = "SHOQERI ME PERGJEGJESI TE KUFIZUAR", "SHOQERI AKSIONARE"
SHPK_OFFICIAL, SHA_OFFICIAL = "Shoqeri me pergjegjesi te kufizuar", "Shoqeri aksionare"


def strip(value: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(value, EDGE_SPACE, "")


def compact_text(value: Column) -> Column:
    """Stripped; blank becomes null; what isn't text is made text first."""
    return F.nullif(strip(value.cast("string")), F.lit(""))


def parse_date(value: Column) -> Column:
    """dd.MM.yyyy, dd/MM/yyyy or yyyy-MM-dd, one- and two-digit days and months; anything else is null."""
    # one expression that holds the value once: it is evaluated once, and parsed by one pattern
    return F.try_to_timestamp(F.regexp_replace(compact_text(value), DAY_FIRST, "$4-$3-$1"), F.lit("yyyy-M-d")).cast("date")


def parse_decimal(value: Column) -> Column:
    """decimal(18,2), commas between thousands removed; anything else is null."""
    return F.replace(compact_text(value), F.lit(","), F.lit("")).try_cast("decimal(18,2)")


def parse_flag(value: Column) -> Column:
    """Three-valued: yes words, no words, else null. Booleans pass through their text."""
    words = F.create_map(*[F.lit(x) for w, flag in [(TRUE_WORDS, True), (FALSE_WORDS, False)] for k in w for x in (k, flag)])
    return F.try_element_at(words, F.lower(strip(value.cast("string"))))


def identifiers(value: Column) -> Column:
    """All distinct identifiers of a text, in upper case, in the order they are met."""
    found = F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(IDENTIFIER), F.lit(0))
    return F.array_distinct(F.transform(found, F.upper))


def single_identifier(value: Column) -> Column:
    """The text's identifier if it has exactly one."""
    lone = F.filter(F.array(identifiers(value)), lambda found: F.size(found) == 1)
    return F.get(F.get(lone, F.lit(0)), F.lit(0))


def normalized_key(value: Column) -> Column:
    """Identifier as a key: stripped, upper case, blank becomes null."""
    return F.nullif(F.upper(strip(value)), F.lit(""))


@cache
def _without_marks() -> tuple[dict[str, str], dict[str, str]]:
    """What NFKD without combining marks makes of single characters: those that become one or none, and those that become
    several; Korean syllables aside, which follow a rule. Characters don't depend on each other, as only marks would be
    put in another order."""
    short, long = {}, {}
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if HANGUL <= code < HANGUL + 19 * 588 or not (unicodedata.decomposition(char) or unicodedata.combining(char)):
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x))
        if plain != char:
            (short if len(plain) < 2 else long)[char] = plain
    return short, long


def _char_class(codes: list[int]) -> str:
    """A character class of code points in order, runs as ranges."""
    runs: list[list[int]] = []
    for code in codes:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in runs) + "]"


def _pairs(entries: dict[str, str]) -> Column:
    """A map as one text, which Spark folds into a constant."""
    return F.str_to_map(F.lit("\x1f".join(f"{k}\x1e{v}" for k, v in entries.items())), F.lit("\x1f"), F.lit("\x1e"))


def strip_accents(value: Column) -> Column:
    """NFKD without combining marks, in the JVM: characters that become one or none are translated; only texts that hold
    others are taken apart."""
    short, long = _without_marks()
    ordered = sorted(short, key=lambda k: not short[k])  # those that vanish come last, beyond the end of the other list
    translated = F.translate(value, "".join(ordered), "".join(short[k] for k in ordered))
    rare = _char_class([*sorted(map(ord, long)), *range(HANGUL, HANGUL + 19 * 588)])
    table = _pairs(long)

    def taken_apart(x: Column) -> Column:
        syllable = F.ascii(x) - HANGUL
        place = lambda n, first, count: F.substring(F.lit("".join(chr(first + k) for k in range(count))), n.cast("int"), F.lit(1))
        tail = F.when(syllable % 28 > 0, place(syllable % 28, 0x11A8, 27)).otherwise("")
        jamo = F.concat(place(F.floor(syllable / 588) + 1, 0x1100, 19), place(F.floor(syllable % 588 / 28) + 1, 0x1161, 21), tail)
        return F.when(syllable.between(0, 19 * 588 - 1), jamo).otherwise(F.coalesce(F.try_element_at(table, x), x))

    return F.when(value.rlike(rare), F.array_join(F.transform(F.split(translated, ""), taken_apart), "")).otherwise(translated)


def unescaped(value: Column) -> Column:
    """Character references that end in a semicolon, named (HTML 5) or by number, as characters; others stay."""
    table = _pairs({k[:-1]: v for k, v in html5.items() if k.endswith(";")})

    def piece(x: Column) -> Column:
        name = F.regexp_extract(x, REFERENCE, 1)
        number = F.when(name.rlike("^#[0-9]"), F.substring(name, 2, 9).cast("int")).when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 9), 16, 10).cast("int"))
        sound = F.when(number.between(1, 0xD7FF) | number.between(0xE000, sys.maxunicode), number)
        char = F.coalesce(F.try_element_at(table, name), F.decode(F.unhex(F.lpad(F.hex(sound), 8, "0")), "UTF-32"))
        return F.coalesce(F.concat(char, F.substr(x, F.length(name) + 3)), x)

    return F.when(value.contains("&"), F.array_join(F.transform(F.split(value, "(?=&)"), piece), "")).otherwise(value)


def label_text(value: Column, accents: bool = True) -> Column:
    """Upper case, runs of anything but letters and digits become one space; blank becomes null."""
    plain = strip_accents(value) if accents else value
    return F.nullif(F.trim(F.regexp_replace(F.upper(plain), "[^A-Z0-9]+", " ")), F.lit(""))


def canonical_legal_form(value: Column, accents: bool = True) -> Column:
    """SHPK and SHA from their short and long spellings, other forms as their label text."""
    label = label_text(value, accents)
    squeezed = F.replace(label, F.lit(" "), F.lit(""))
    return F.when((squeezed == "SHPK") | (label == SHPK_LONG), "SHPK").when((squeezed == "SHA") | (label == SHA_LONG), "SHA").otherwise(label)


def official_legal_form(value: Column, accents: bool = True) -> Column:
    """The registry's own name of SHPK and SHA; other forms as they are, stripped."""
    canonical = canonical_legal_form(value, accents)
    return F.when(canonical == "SHPK", SHPK_OFFICIAL).when(canonical == "SHA", SHA_OFFICIAL).otherwise(compact_text(value))


def slug(value: Column) -> Column:
    """Upper case, anything but letters and digits becomes _, none at the ends; empty becomes UNKNOWN."""
    body = F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(value, F.lit(""))), "[^A-Z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(body, F.lit("")), F.lit("UNKNOWN"))


def snapshot_key(nipt: Column, legal_form: Column, fields: Column, date_from: Column, date_to: Column, accents: bool = True) -> Column:
    """[nipt][|legal_form:X][|field:SLUG ...]|from|to; `all` stands for no subject, `none` for no date.
    fields: an array of structs name, value; null for none."""
    parts = F.transform(F.coalesce(fields, F.array().cast("array<struct<name:string,value:string>>")), lambda x: F.concat(x["name"], F.lit(":"), slug(x["value"])))
    form = F.when(F.coalesce(legal_form, F.lit("")) != "", F.concat(F.lit("legal_form:"), F.coalesce(canonical_legal_form(legal_form, accents), strip(legal_form))))
    subject = F.concat_ws("|", F.nullif(nipt, F.lit("")), form, F.nullif(F.concat_ws("|", parts), F.lit("")))
    return F.concat_ws("|", F.coalesce(F.nullif(subject, F.lit("")), F.lit("all")), F.coalesce(date_from.cast("string"), F.lit("none")), F.coalesce(date_to.cast("string"), F.lit("none")))


def run_mode(legal_form: Column, limit: int = 50) -> Column:
    """daily_legal_form:NAME with letters and digits only; one that is too long is cut and ends in eight hex digits of
    the form's SHA-1. Without a form, daily_range."""
    prefix = "daily_legal_form:"
    name = F.coalesce(F.nullif(F.regexp_replace(F.upper(legal_form), "[^A-Z0-9]+", ""), F.lit("")), F.lit("UNKNOWN"))
    room = max(1, limit - len(prefix) - 9)
    cut = F.concat(F.lit(prefix), F.substring(name, 1, room), F.lit("-"), F.substring(F.sha1(legal_form), 1, 8))
    return F.when(legal_form.isNull(), "daily_range").when(F.length(name) + len(prefix) <= limit, F.concat(F.lit(prefix), name)).otherwise(cut)


def extension(content_type: Column, url: Column) -> Column:
    """.csv, .pdf or .json by the url's ending or the content type, in that order; .html without either."""
    out = F
    for name in ("csv", "pdf", "json"):
        out = out.when(F.coalesce(url, F.lit("")).endswith(f".{name}") | F.coalesce(content_type, F.lit("")).contains(name), f".{name}")
    return out.otherwise(".html")


def storage_name(digest: Column, suffix: Column, filename: Column) -> Column:
    """stem-digest.ext of a requested file name, else digest.ext; suffix is used where the name has none."""
    stem = F.coalesce(F.nullif(F.regexp_extract(filename, r"^(.+?)(\.[^.]+)?$", 1), F.lit("")), digest)
    own = F.coalesce(F.nullif(F.regexp_extract(filename, r"^.+?(\.[^.]+)$", 1), F.lit("")), suffix)
    return F.when(filename.isNull(), F.concat(digest, suffix)).otherwise(F.concat(stem, F.lit("-"), digest, own))


def storage_partition(source: Column, day: Column, kind: Column) -> Column:
    return F.concat_ws("/", source, F.date_format(day, "yyyy/MM/dd"), kind)


def safe_file_part(value: Column, fallback: str = "document") -> Column:
    """Runs of anything but letters, digits, dash and underscore become _, none at the ends; empty becomes the fallback."""
    body = F.regexp_replace(F.regexp_replace(strip(value), "[^A-Za-z0-9_-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(body, F.lit("")), F.lit(fallback))


def form_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def embedded_date(text: Column) -> Column:
    """The first d.m.yyyy (also with / or -) that stands alone in a text; null if that isn't a date."""
    part = [F.regexp_extract(text, r"(?<![\p{L}\p{N}_])(\d{1,2})[./-](\d{1,2})[./-](\d{4})(?![\p{L}\p{N}_])", k) for k in (1, 2, 3)]
    return F.try_to_timestamp(F.concat_ws("-", part[2], part[1], part[0]), F.lit("yyyy-M-d")).cast("date")


def without_dots(path: Column) -> Column:
    """An absolute path with its . and .. segments folded; one at the end leaves the folder."""
    parts = F.split(path, "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(parts, none, lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    return F.array_join(F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def absolute_url(base: Column, href: Column) -> Column:
    """href resolved against base as RFC 3986 has it; an empty href is the base."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    own_path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(own_path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    path, tail = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href == "", base)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(root, own_path, href))
        .otherwise(F.concat(root, without_dots(F.when(href.startswith("/"), path).otherwise(F.concat(folder, path))), tail))
    )


def document_kind(kind: Column) -> Column:
    """Fetch kind of a document type, null for an unknown one."""
    word = F.lower(compact_text(kind))
    out = F
    for name, value in DOCUMENT_KINDS.items():
        out = out.when(word == name, value)
    return out.otherwise(None)


def corruption_reason(issue: Column) -> Column:
    out = F
    for name, value in CORRUPTION_REASONS.items():
        out = out.when(issue == name, value)
    return out.otherwise(F.replace(issue, F.lit("_"), F.lit(" ")))


def is_ranged_search(nipt: Column, date_from: Column, date_to: Column) -> Column:
    return nipt.isNull() & date_from.isNotNull() & date_to.isNotNull()
