"""Main text of HTML pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Every word scores by where it
stands (its block element, inside a link or not, inside boilerplate or not)
and every tag scores negative; the weights are learned from *labelled
pages*: pages that mark their article themselves (one ``<article>``
element). One linear scan finds the contiguous run of tokens with the
largest total, the content region. Marked-up boilerplate inside the region
(scripts, styles, navigation, adverts, forms, comments and the like) is
left out of the text: an element counts as boilerplate by its kind (navigation,
footer, form, script, ...), or when the parts of its class and id names speak
against it. Parts have weights like words and tags: learned where the
labelled pages show them, else from a short list; standing inside an article
and holding running text count in the element's favour.

Weights: a word's is ``2 P(article | place) - 1``, a tag's is ``-(0.05 +
0.3 P(outside | tag))``, both from smoothed counts over at most about
``max_pages`` labelled pages (hash-chosen). Places that no labelled page
shows use fixed defaults. The article element itself is no feature, so the
weights carry over to pages without one.

The text: character references decoded, white space inside a block turned
into one space, blocks (ended by block tags and ``br``) trimmed and joined
by one space; inline tags add nothing.

Edge cases: null, empty and textless pages give an empty text; unclosed
elements and a page cut off anywhere are read as far as they go (an
unfinished tag at the end is no text); without labelled pages the defaults
are used; of equal totals the first and shortest region wins; repeated rows
are extracted alike; extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

# Fixed values of HTML: elements by role.
BLOCK = set("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section select summary table tbody td "
            "tfoot th thead title tr ul caption".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math object".split())
SKIP = set("script style noscript template iframe svg math object head title nav footer aside form button select textarea "
           "input label option dialog menu canvas audio video map".split())
# Parts of class and id names and how strongly one speaks against its element, where the labelled
# pages do not show it; and role values of page furniture.
PARTS = {
    **dict.fromkeys("ad ads adv advert adverts advertisement advertising banner comment comments comentarios consent cookie cookies "
                    "disqus gdpr newsletter popup promo promoted sponsor sponsored subscribe".split(), -3.0),
    **dict.fromkeys("alert breadcrumb breadcrumbs footer login masthead menu modal nav navbar navigation notice notices pager pagination "
                    "recommended related replies reply respond share sharing sidebar signup skip social toolbar topbar widget "
                    "widgets".split(), -2.0),
    **dict.fromkeys("copyright cta disclaimer discussion form legal reactions search tags".split(), -1.0)}
ROLES = set("complementary contentinfo navigation search banner alert dialog menu toolbar".split())
#: A name with one of these tells what its element has or lacks, not what it is (has-sidebar, no-comments).
HAVING = set("has have no not with without is".split())
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Elements that hold running text themselves.
TEXTUAL = set("p h1 h2 h3 h4 h5 h6 blockquote pre dt dd td th figcaption".split())
#: How many labelled elements a name part needs before what they show counts half.
SEEN_HALF = 20
#: Elements whose id is the target of a link, not the name of a part of the page.
ANCHORS = set("h1 h2 h3 h4 h5 h6 a".split())
CLOSES = {"p": BLOCK - {"br", "hr", "body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
          "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)"
                   r"|<(?=[/a-zA-Z!?])[^>]*(?:>|\Z)", re.S)
#: One attribute: its name and its whole value, if it has one.
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")

TAG_DEFAULT, WORD_DEFAULT, LINK_DEFAULT, NOISE_DEFAULT, BEHIND_DEFAULT = -0.2, 0.6, -0.3, -1.0, -0.5
#: The least that one run of boilerplate tokens adds up to: an advert or form inside an article must
#: not cut the article in two, whatever its length.
NOISE_LEAST = -1.0


def name_parts(value: str) -> set[str]:
    """Lower-case parts of the names in an attribute's value: split at anything but letters, and where a capital begins a part."""
    out: set[str] = set()
    for name in value.split():
        parts = {p.lower() for p in PART.findall(name)}
        if not parts & HAVING:
            out |= parts
    return out


def _marked(name: str, attributes: str, inside_article: bool, weights: dict[str, float]) -> tuple[bool, float, set[str]]:
    """Whether an element is boilerplate by its kind or as hidden; how its names score (below 0: they speak
    against it); and the parts of its names.

    The names' score is that of their worst part (learned, else as listed), one better inside an article and
    one better for an element that holds running text itself."""
    if name in SKIP or (name == "header" and not inside_article):
        return True, 0.0, set()
    if not attributes or name in ("html", "body", "article", "main"):
        return False, 0.0, set()
    parts: set[str] = set()
    worst = 0.0
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (
                key == "style" and "display:none" in value.lower().replace(" ", "")):
            return True, 0.0, set()
        if key == "role" and value.lower() in ROLES:
            worst = -3.0
        # ids of headings and links, and of sections of an article, are anchors
        if key == "class" or (key == "id" and name not in ANCHORS and not (name == "section" and inside_article)):
            parts |= name_parts(value)
    worst = min([worst, *[weights.get(f"n:{p}", PARTS.get(p, 0.0)) for p in parts]])
    return False, worst + inside_article + (name in TEXTUAL) if worst < 0 else 0.0, parts


def scan(page: str, weights: dict[str, float] | None = None) -> list[tuple[str, str, bool, bool]]:
    """Tokens of a page: (feature, text, boilerplate, inside an article element).

    A text token holds a piece of text (its feature is its words' place: ``w``, ``x`` in boilerplate, ``o``
    behind the last article or main element); a tag token's text is a line feed if the tag ends a block, else
    empty; a token ``n:part`` without text stands for a part of an element's names.

    An element that only its names speak against is no boilerplate if it holds an article or main element, or,
    unless a part speaks most strongly, most of the words that stand neither in boilerplate by kind nor in links,
    unless the page has an article or main element elsewhere."""
    weights = weights or {}
    out, named, words, marked = _scan(page, frozenset(), weights)
    kept = frozenset(at for at, (held, holds, inside, score) in named.items()
                     if holds or (score > -2 and 2 * held > words and (inside or not marked)))
    return _scan(page, kept, weights)[0] if kept else out


def _scan(page: str, kept: frozenset[int], weights: dict[str, float]) -> tuple[list[tuple[str, str, bool, bool]], dict[int, list], int, bool]:
    """The tokens; of each element that its names speak against, by its place in the page, its words, whether it
    holds or is in an article or main, and its names' score; all words; whether the page has an article or main. ``kept``: such elements that are no boilerplate."""
    out: list[tuple[str, str, bool, bool]] = []
    # open elements, whether each starts boilerplate, and whether by its kind
    stack: list[tuple[str, bool, bool]] = []
    named: dict[int, list] = {}                 # elements marked by name only
    begun: dict[int, tuple[int, int]] = {}      # of those still open, by depth: place and words before
    noise = sure = article = links = words = 0
    marked = False
    behind = None                               # tokens before the end of the last article or main
    place = "body"
    at = 0

    def leave(entry: tuple[str, bool, bool]) -> None:
        nonlocal noise, sure, article, links, behind
        name, bad, kind = entry
        if name in ("article", "main"):
            behind = len(out)
        noise -= bad
        sure -= kind
        if len(stack) in begun:
            place_of, before = begun.pop(len(stack))
            named[place_of][0] = words - before
        article -= name == "article"
        links -= name == "a"

    def where() -> str:
        return next((n for n, *_ in reversed(stack) if n in BLOCK), "body")

    def text(piece: str) -> None:
        nonlocal words
        if piece.strip():
            words += 0 if sure or links else _words(piece)
            out.append((f"{'x' if noise else 'w'}:{place}{':a' if links else ''}", piece, noise > 0, article > 0))
        elif piece:
            out.append(("", piece, noise > 0, article > 0))

    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        closing = m.group(1) == "/"
        if closing:
            if any(n == name for n, *_ in stack):
                while stack:
                    entry = stack.pop()
                    leave(entry)
                    if entry[0] == name:
                        break
        elif name not in VOID:
            while stack and name in CLOSES.get(stack[-1][0], ()):
                leave(stack.pop())
            kind, score, parts = _marked(name, m.group(3) or "", article > 0, weights)
            by_name = score < 0
            out += [(f"n:{p}", "", noise > 0, article > 0) for p in sorted(parts)]
            if name in ("article", "main"):
                marked = True
                for place_of, _ in begun.values():
                    named[place_of][1] = True
            if by_name:
                named[m.start()] = [0, False, any(n in ("article", "main") for n, *_ in stack), score]
                begun[len(stack)] = (m.start(), words)
            bad = kind or (by_name and m.start() not in kept)
            stack.append((name, bad, kind))
            noise += bad
            sure += kind
            article += name == "article"
            links += name == "a"
        place = where()
        out.append((f"{'/' if closing else ''}{name if name in BLOCK or name in VOID or name in SKIP or name == 'a' else 'inline'}",
                    "\n" if name in BLOCK else "", noise > 0, article > 0))
        if name in ("svg", "math") and not closing and (m.group(3) or "").endswith("/"):   # ends where it begins
            leave(stack.pop())
            place = where()
        elif name in RAW and not closing:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if name == "title":
                text(page[at:end.start() if end else len(page)])
            at = end.end() if end else len(page)
            leave(stack.pop())
            place = where()
    open_ = any(n in ("article", "main") for n, *_ in stack)
    while stack:
        leave(stack.pop())
    if behind is not None and not open_:
        out[behind:] = [("o" + f[1:] if f[:2] == "w:" else f, piece, bad, inside) for f, piece, bad, inside in out[behind:]]
    return out, named, words, marked


def _words(piece: str) -> int:
    return len(piece.split())


def weight_of(feature: str, weights: dict[str, float]) -> float:
    known = weights.get(feature)
    if known is not None:
        return known
    if feature[1:2] != ":":
        return TAG_DEFAULT
    if feature[0] == "o":
        return BEHIND_DEFAULT
    return NOISE_DEFAULT if feature[0] == "x" else LINK_DEFAULT if feature.endswith(":a") else WORD_DEFAULT


def region(found: list[tuple[str, str, bool, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """First and last-plus-one token of the maximum-scoring subsequence (one linear scan)."""
    best, span, total, start, spent = 0.0, (0, 0), 0.0, 0, 0.0
    for i, (feature, piece, noise, _) in enumerate(found):
        if not feature or feature[:2] == "n:":
            continue
        word = feature[1:2] == ":"
        add = weight_of(feature, weights) * (_words(piece) if word else 1)
        if noise:
            add = max(add, NOISE_LEAST - spent)
            spent += add
        else:
            spent = 0.0
        total += add
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, span = total, (start, i + 1)
    return span


def extract(page: str, weights: dict[str, float]) -> str:
    """The content region's text without marked-up boilerplate."""
    found = scan(page, weights)
    lo, hi = region(found, weights)
    pieces = [piece if piece == "\n" and feature else html.unescape(piece)
              for feature, piece, noise, _ in found[lo:hi] if not noise or piece == "\n"]
    return " ".join("".join(pieces).split())


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", max_pages: int = 4000) -> dict[str, float]:
    """Weights of places and tags, from pages with exactly one article element."""
    marked = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html")).filter(
        F.regexp_count(F.col("_html"), F.lit("(?i)<article[\\s>]")) == 1)
    n = marked.count()
    if not n:
        return {}
    part = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1_000_000))
    sample = marked.filter(part < int(1e6 * min(1.0, max_pages / n)) + 1).select("_html")
    schema = StructType([StructField("feature", StringType()), StructField("inside", BooleanType()), StructField("n", LongType())])

    def count(batches):
        total: dict[tuple[str, bool], int] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                for feature, piece, _, inside in scan(page):
                    if feature:
                        k = (feature, inside)
                        total[k] = total.get(k, 0) + (_words(piece) if feature[1:2] == ":" and feature[0] != "n" else 1)
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
                                          pa.array([total[k] for k in keys], pa.int64())], names=schema.fieldNames())

    seen = sample.mapInArrow(count, schema).groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()  # places and tags
    counts: dict[str, list[int]] = {}
    for r in seen:
        counts.setdefault(r.feature, [0, 0])[r.inside] += r.n
    weights = {}
    for feature, (out, inside) in counts.items():
        share = (inside + 1) / (out + inside + 2)
        if feature[:2] == "n:":
            # what an article holds may still be an advert: pages can only clear parts that are not listed, or add to them
            part, n = feature[2:], out + inside
            if part not in PARTS:
                weights[feature] = (2 * share - 1) * n / (n + SEEN_HALF)
            continue
        weights[feature] = 2 * share - 1 if feature[1:2] == ":" else -(0.05 + 0.3 * (1 - share))
    return weights


def extract_pages(pages: DataFrame, weights: dict[str, float], html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, text and n_chars (code points)."""
    src = pages.select(*keep, F.col(html_col).alias("__html"))
    schema = StructType([*[src.schema[k] for k in keep], StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches):
        for batch in batches:
            texts = [extract(p or "", weights) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.fieldNames())

    return src.mapInArrow(run, schema)
