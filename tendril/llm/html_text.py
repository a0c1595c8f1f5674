"""Main text of HTML pages by two-pass block rules.

The page is cut into blocks at block-level tags. Pass one labels each block good, bad or undecided from its
stop-word density, its length, its link density and the kind of container it stands in (on pages in other languages than
the listed ones, length and ends of sentences stand in for stop words). Pass two lets the
undecided ones (mostly short ones) take the label of the nearest decided neighbour in the same part of the page.

Defined cases: null html counts as empty and gives the empty text; broken markup (unclosed elements, a page cut
off in a tag, script or comment) is read as far as it goes; repeated rows give one result each; page_id and url
pass through, nulls included; columns beyond those three are ignored. A page is processed whole, however long.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tendril.llm.shared import table

# Frequent function words of the languages that are expected.
STOP_WORDS = frozenset(
    """a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its
    more no not of on one or our out she so than that the their them there they this to up was we were what when which
    who will with would you your
    au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me même mes moi mon ne nos
    notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous
    aber als am auch auf aus bei bin bis da das dass dem den der des die dir doch du durch ein eine einem einen einer eines
    er es für hat ich ihr im in ist ja mich mir mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor
    war was wenn werden wie wir zu zum zur
    al como con cuando del desde donde dos el ella ellos entre era eres es esta este estos fue ha hasta hay la las lo los más
    mi muy nada ni no nos o para pero por porque que quien se ser si sin sobre su sus también te tiene todo tu un una y ya yo"""
    .split()
)

# Elements by what they do to the text.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("head svg math template button select option datalist object audio video canvas map applet".split())
SIDE = frozenset("nav footer aside form menu dialog search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
# Words in names of containers. Those of the first group say by themselves what a container is; those of the
# second do if the whole name is made of listed words, and otherwise (form-of-government) leave it to the contents.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo nav navbar topmenu submenu breadcrumb breadcrumbs"
    " pagination sidebar widgets footer masthead comment comments commentlist disqus cookie cookies gdpr popup modal newsletter"
    " searchbox teaser teasers toolbar".split()
)
PERHAPS_SIDE_WORDS = frozenset(
    "promotion banner navigation menu pager side widget header respond reply replies reviews consent notice notices notification alert"
    " overlay subscribe subscription signup login share sharing social related recommended recommendations search legal copyright"
    " disclaimer skip hidden form".split()
)
PLAIN_WORDS = frozenset(
    "a area article articles bar block body bottom box btn button buttons col column container content contents desktop entry field global"
    " group holder home icon icons inner item items left link links list main mobile more news outer page pages panel post posts primary"
    " reader right row secondary section site slot stories story text the title to tools top unit user view wrap wrapper x".split()
)

#: Names that say what a container lacks or has beside it, not what it is.
NOT_ITSELF = re.compile(r"(?:^|(?<=\s))(?:no|not|non|has|with|without)[-_]\S+", re.I)
#: Of the names, those that keep an article element from being the article.
SIDE_ARTICLE = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|sponsored|promo|comment|comments|reply|related|recommended|teaser|teasers)(?:$|[\s_-])", re.I)

#: A quote opens a value only right after `=`; elsewhere, as in title=don't, it is a character like others.
TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*'|(?!["'])[^\s>]*+))*+>|[^>]*(?:>|\Z))|<[!?][^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

SHORT = 70  # characters below which a block's own words don't decide
LONG = 200
LOW_STOPS, HIGH_STOPS = 0.1, 0.2
LINKS = 0.5
LINK_RUN = 3  # blocks in a row that are nothing but a link are a list of links
LABEL = 25  # characters below which a link alone is a label, such as "read more"
FOREIGN = 0.02  # share of stop words of a page below which its language isn't among those listed
SENTENCE_ENDS = ".!?…。！？｡؟۔।։"
OUTSIDE, SIBLING = 2, 4
GOOD, BAD, UNDECIDED = 1, -1, 0


class Block:
    __slots__ = ("heading", "linked", "links", "part", "parts", "perhaps", "side", "text")

    def __init__(self, part: int, side: bool, perhaps: int, heading: bool):
        self.part, self.side, self.perhaps, self.heading = part, side, perhaps, heading
        self.parts: list[str] = []
        self.linked, self.links = 0, set()


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def side_name(names: str) -> int:
    """2 if a class or id says that a container isn't the article, 1 if one of its words may say so, else 0."""
    most = 0
    for name in names.lower().split():
        words = [w for w in re.split(r"[_-]+", name) if w and not w.isdigit()]
        if any(w in SIDE_WORDS for w in words):
            return 2
        if any(w in PERHAPS_SIDE_WORDS for w in words):
            if all(w in PERHAPS_SIDE_WORDS or w in PLAIN_WORDS for w in words):
                return 2
            most = 1
    return most


def is_side(tag: str, text: str, in_article: bool) -> int:
    """Whether an element holds what is not the article (2), perhaps (1, its contents decide) or not (0): by its tag, or
    else by its role, class, id or style."""
    if tag in SIDE or (tag == "header" and not in_article):
        return 2
    if "=" not in text and "hidden" not in text:
        return 0
    a = attributes(text)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return 2
    if a.get("role", "").lower() in SIDE_ROLES:
        return 2
    if tag in ("body", "html", "main"):
        return 0
    names = [NOT_ITSELF.sub("", a.get(k, "")) for k in ("class", "id")]
    if in_article:  # an article's own heading
        names = [re.sub("header|masthead", "", x, flags=re.I) for x in names]
    if tag == "article":
        return 2 * any(SIDE_ARTICLE.search(x) is not None for x in names)
    return max(map(side_name, names))


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in page order. `part` numbers the article element a block stands in, 0 for none."""
    blocks: list[Block] = []
    stack: list[tuple[str, bool, int, int]] = []  # open elements; before each: whether in a side container, part, perhaps
    side, part, parts, links, dropped, link = False, 0, 0, 0, 0, 0
    perhaps, doubts = 0, 0  # number of the outermost container that may be a side one
    now: Block | None = None
    heading = False
    opened: Counter[str] = Counter()

    def put(text: str) -> None:
        nonlocal now
        if now is None:
            if not text or text.isspace():
                return
            now = Block(part, side, perhaps, heading)
            blocks.append(now)
        now.parts.append(text)
        if links:
            now.linked += len(text.strip())
            if text.strip():
                now.links.add(link)

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        start = m.start() if m else size
        if start > at and not dropped:
            put(html.unescape(page[at:start]) if "&" in page[at:start] else page[at:start])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in ("html", "img", "wbr") or (tag in VOID and tag not in BLOCK):
            continue
        if tag == "body" and dropped:  # an unclosed head ends here
            stack, dropped = [x for x in stack if x[0] not in DROPPED], 0
            opened = Counter(x[0] for x in stack)
        if tag in BLOCK:
            now = None
        if closing:
            if opened[tag]:
                while True:
                    was, side, part, perhaps = stack.pop()
                    opened[was] -= 1
                    dropped -= was in DROPPED
                    links -= was == "a"
                    heading = heading and was not in HEADING
                    if was == tag:
                        break
            continue
        if tag in VOID or m[3].endswith("/>") and tag in ("svg", "path", "object"):
            continue
        if tag in ("article", "main") and side and is_side(tag, m[3], False) < 2:
            if not opened["article"] and not opened["main"]:  # what it seems to stand in was never closed
                stack, side, perhaps, links, dropped = [], False, 0, 0, 0
                opened.clear()
        if tag in ("p", "li", "dd", "dt", "tr", "td", "th", "option") or tag in HEADING:  # these end one like themselves
            while stack and stack[-1][0] not in BLOCK or stack and stack[-1][0] == tag:
                was, side, part, perhaps = stack.pop()
                opened[was] -= 1
                dropped -= was in DROPPED
                links -= was == "a"
                if was == tag:
                    break
        if tag in BLOCK or tag in DROPPED or tag in ("a", "span", "ins", "b", "i", "em", "strong", "label"):
            stack.append((tag, side, part, perhaps))
            opened[tag] += 1
            dropped += tag in DROPPED
            links += tag == "a"
            link += tag == "a"
            heading = tag in HEADING or heading and tag not in BLOCK
            if tag in ("article", "main") and not side and not part:
                parts += 1
                part = parts
            if tag not in ("a", "b", "i", "em", "strong"):
                what = is_side(tag, m[3], part > 0)
                side = side or what == 2
                if what == 1 and not perhaps:
                    doubts += 1
                    perhaps = doubts
    for x in blocks:
        x.text = " ".join("".join(x.parts).split())
    return decided_containers([x for x in blocks if x.text])


def decided_containers(blocks: list[Block]) -> list[Block]:
    """Containers whose names leave it open are side ones if they hold little text or mostly links."""
    size: Counter[int] = Counter()
    linked: Counter[int] = Counter()
    for x in blocks:
        if not x.side:
            size[x.perhaps] += len(x.text)
            linked[x.perhaps] += x.linked
    for x in blocks:
        x.side = x.side or x.perhaps > 0 and (size[x.perhaps] < LONG or linked[x.perhaps] > LINKS * size[x.perhaps])
    return blocks


def stop_words_of(text: str) -> tuple[int, int]:
    """How many of a text's words are stop words, and how many words there are."""
    words = [w.strip(".,;:!?%*#$&|\"'()") for w in text.lower().split()]
    return sum(w in STOP_WORDS for w in words), len(words)


def link_lists(blocks: list[Block]) -> set[int]:
    """Places of blocks that stand in a run of LINK_RUN or more which are nothing but a link."""
    alone = [not x.side and not x.heading and x.linked > 0.9 * len(x.text) for x in blocks]
    found: set[int] = set()
    k = 0
    while k < len(blocks):
        end = k
        while end < len(blocks) and alone[end]:
            end += 1
        if end - k >= LINK_RUN:
            found.update(range(k, end))
        k = max(end, k + 1)
    return found


def of_links(block: Block, in_list: bool) -> int:
    """A block that is mostly links: bad, but for one in an article which neighbours decide: a long one, or one with a
    single link that is no label and stands in no list of links."""
    if not block.part:
        return BAD
    label = len(block.text) < LABEL and block.text[-1] not in SENTENCE_ENDS and block.linked > 0.9 * len(block.text)
    return BAD if in_list or label or len(block.links) > 1 else UNDECIDED


def first_pass(blocks: list[Block]) -> list[int]:
    """Of each block good or bad if it decides by itself, else undecided. On a page that has next to none of the listed
    stop words (another language), length and ends of sentences stand in for them."""
    stops = [stop_words_of(x.text) if not x.side else (0, 0) for x in blocks]
    found, words = map(sum, zip(*stops, strict=True)) if blocks else (0, 0)
    foreign = found < FOREIGN * words or not found
    lists = link_lists(blocks)

    def label(k: int, x: Block) -> int:
        length = len(x.text)
        if x.side:
            return BAD
        if x.linked > LINKS * length and not x.heading and (length < LONG or not x.part):
            return of_links(x, k in lists)
        if (len(x.text.encode()) if foreign else length) < SHORT:  # a character of other scripts may say more than a letter
            return UNDECIDED
        if foreign:
            return GOOD if any(end in x.text for end in SENTENCE_ENDS) else UNDECIDED
        share = stops[k][0] / max(1, stops[k][1])
        if share >= HIGH_STOPS or length >= LONG and share >= LOW_STOPS:
            return GOOD
        return UNDECIDED if x.part or share >= LOW_STOPS else BAD

    return [label(k, x) for k, x in enumerate(blocks)]


def second_pass(blocks: list[Block], labels: list[int]) -> list[int]:
    """Undecided blocks take the label of the nearest decided one of their part; of two as near, a good one wins.
    Without any, a block in an article is good, one outside is good if it reads like a sentence."""
    def nearest(order: range) -> list[tuple[int, int]]:
        """For each block, distance to and label of the last decided block of its part in this order."""
        found, last = [(len(blocks), UNDECIDED)] * len(blocks), {}
        for k in order:
            x = blocks[k]
            if x.part in last:
                found[k] = (abs(k - last[x.part]), labels[last[x.part]])
            if labels[k] != UNDECIDED and not x.side:
                last[x.part] = k
        return found

    out = list(labels)
    before, after = nearest(range(len(blocks))), nearest(range(len(blocks) - 1, -1, -1))
    for k, x in enumerate(blocks):
        if labels[k] == UNDECIDED:
            alone = GOOD if x.part or x.heading or x.text[-1] in SENTENCE_ENDS else BAD
            far = min(before[k][0], after[k][0])
            out[k] = alone if far == len(blocks) else max(label for d, label in (before[k], after[k]) if d == far)
    return out


def main_text(page: str | None) -> str:
    """The main text of one page; blocks joined by an empty line.

    The article is the article element with the most good text, or what stands outside of all of them if that has over
    twice as much (a page whose body stands beside a card that is marked up as an article). Sibling articles with at
    least a quarter of its good text, decided by the blocks themselves, are parts of it."""
    blocks = blocks_of(page or "")
    firm = first_pass(blocks)
    labels = second_pass(blocks, firm)
    good: dict[int, int] = {}
    decided: dict[int, int] = {}
    for x, label, own in zip(blocks, labels, firm, strict=True):
        good[x.part] = good.get(x.part, 0) + (label == GOOD) * len(x.text)
        decided[x.part] = decided.get(x.part, 0) + (own == GOOD) * len(x.text)
    articles = [p for p in good if p]
    part = max(articles, key=good.get, default=0)
    if good.get(0, 0) > OUTSIDE * good.get(part, 0):
        part = 0
    parts = {part, *(p for p in articles if SIBLING * decided[p] > good[part])}
    return "\n\n".join(x.text for x, label in zip(blocks, labels, strict=True) if label == GOOD and x.part in parts)


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars: a narrow job, no shuffle."""
    kept = pages.select("page_id", "url", html_col)
    id_type = kept.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return kept.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
