"""The main text of web pages, as the contiguous run of words and tags with the largest score.

A page is a row of words and tags. Words score positive and tags negative; how much is learned from pages
whose markup names the article: a word by the tag it stands in, a tag by its name and what its class says
it is. A linear scan finds the run with the largest sum; if one
``article`` holds it, all of that is taken. Of its blocks, those in elements that are never
part of an article (menus, adverts, forms, comments, ...) are left out. Such an element does not take out
the article that it is wrapped around, nor, if its name may be that of a layout, most of the page's words.

At scale: two passes over the pages without a shuffle of them. The counts for the weights cover all pages
and are summed per kind of word and tag, of which there are a few hundred at most.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.quality import texts_of

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<svg\b(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+(?<=/)>"""  # an empty svg
    r"|<(script|style|noscript|template|svg|textarea|iframe|title)\b[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<[/!?a-zA-Z][^>]*+(?:>|\Z)""",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)

#: Elements with no end tag, those that stay within a block, and those whose text is no article's.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
OUTSIDE = frozenset("head nav aside footer form button select option dialog menu object canvas audio video map".split())
#: What a class, id or role says: parts of names that mark text beside the article.
BESIDE = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notification popup promo promoted promotion related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: What marks an article as one beside the article, and class names that only speak of something beside.
BESIDE_ARTICLES = frozenset("ad ads advert comment comments promo related replies reply sponsored".split())
ABOUT = ("has-", "no-", "with-", "without-")
#: Elements that are also put around whole pages, and names of what may well have more words than the article.
WRAPPERS = frozenset("head form".split())
LONGER = frozenset("comment comments disqus related replies reply respond".split())
PARTS = re.compile(r"[a-z]+")
#: Scores without labelled pages, and bounds on learned ones.
WORD, MARK, LEAST, MOST = 1.0, -3.25, 0.05, 6.0


def named(attributes: str) -> set[str]:
    """The parts of the names that class, id and role give."""
    names = (found[2] or found[3] or found[4] or "" for found in NAMED.finditer(attributes))
    return {part for name in names for word in name.lower().split() if not word.startswith(ABOUT) and not word.endswith("-free") for part in PARTS.findall(word)}


def takes_out(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element's class, id or role, or its being hidden, says that its text is not the article's."""
    if not attributes or name in ("html", "body", "main"):
        return False
    if HIDDEN.search(attributes):
        return True
    parts = named(attributes)
    if name == "article":
        return not BESIDE_ARTICLES.isdisjoint(parts)
    page_header = "header" in parts and not in_article and parts.isdisjoint(("article", "content", "entry", "post", "story"))
    return page_header or not BESIDE.isdisjoint(parts)


class Page:
    """A page's tokens in order: ``kinds`` (of word or tag), ``counts`` (words, 0 for a tag), ``texts``.

    ``block`` numbers the block a run of words is in, ``out`` tells whether an element takes it out of
    any article, ``inside`` whether it stands in an ``article``, ``holder`` in which outermost one of those
    (or else of ``main``), 0 for none.

    Which elements take their text out is settled at the end of the page. Until then ``around`` numbers the
    list of such elements around a token, of which each is ``takers``' (list outside of it, token, whether it
    may be a wrapper, whether it is hidden), or, in place of an element, an article or main, whose text the
    list outside may not take out.
    """

    def __init__(self, source: str):
        self.kinds: list[str] = []
        self.counts: list[int] = []
        self.texts: list[str] = []
        self.block: list[int] = []
        self.inside: list[bool] = []
        self.holder: list[int] = []
        self.around: list[int] = []
        self.takers: list[tuple[int, int, bool, bool] | None] = [None]
        self.held_at: set[int] = set()  # the lists that end in an article or main
        self.articles = held = mains = main = 0
        opened: list[tuple[str, int]] = []  # name, and the list outside of it
        outs = blocks = within = at = 0

        def add(kind: str, words: int, text: str) -> None:
            self.kinds.append(kind)
            self.counts.append(words)
            self.texts.append(text)
            self.block.append(blocks)
            self.around.append(outs)
            self.inside.append(within > 0)
            self.holder.append(held if within else -main)

        def words(text: str) -> None:
            if text:
                text = html.unescape(text)
                n = len(text.split())
                add("w:" + next((name for name, _ in reversed(opened) if name not in INLINE or name == "a"), ""), n, text)

        def close(k: int) -> None:
            nonlocal outs, within, main
            outs = opened[k][1]
            for name, _ in opened[k:]:
                within -= name == "article"
                main = 0 if name == "main" else main
            del opened[k:]

        for tag in TAG.finditer(source):
            words(source[at : tag.start()])
            at = tag.end()
            name = (tag[3] or "").lower()
            if not name:
                continue
            if name not in INLINE:
                blocks += 1
            if tag[2]:
                k = next((i for i in range(len(opened) - 1, -1, -1) if opened[i][0] == name), None)
                add(f"/{name}", 0, "")
                if k is not None:
                    close(k)
                continue
            if name == "p":  # a paragraph ends where the next begins
                k = next((i for i in range(len(opened) - 1, -1, -1) if opened[i][0] not in INLINE), None)
                if k is not None and opened[k][0] == "p":
                    close(k)
            attributes = tag[4] or ""
            if attributes.endswith("/") and name not in INLINE | {"p", "div", "article", "section", "main"}:
                add(name, 0, "")
                continue
            marked = takes_out(name, attributes, within > 0)
            outermost = not marked and not within and (name == "article" or name == "main" and not main)
            if name == "article":
                self.articles += 1
                held = held if within else held + 1
                within += 1
            elif name == "main":
                mains += 1
                main = mains
            add(name + "!" * marked, 0, "")
            if name not in VOID:
                opened.append((name, outs))
                hidden = bool(marked and HIDDEN.search(attributes))
                if marked or name in OUTSIDE or (name == "header" and not within):
                    wrapper = not hidden and (name in WRAPPERS or name not in OUTSIDE and name not in ("article", "header")) and LONGER.isdisjoint(named(attributes))
                    self.takers.append((outs, len(self.kinds) - 1, wrapper, hidden))
                    outs = len(self.takers) - 1
                elif outermost:
                    self.takers.append((outs, len(self.kinds) - 1, False, False))
                    outs = len(self.takers) - 1
                    self.held_at.add(outs)
        words(source[at:])
        self.out = self._settled()

    def _settled(self) -> list[bool]:
        """Whether each token is out.

        A wrapper counts as a plain tag if it holds more than half of the words that are neither links nor in
        elements that cannot be wrappers, and no article or main stands free beside it. An article or main
        is not taken out by what is around it, unless that is hidden, or the page has one with as many words
        that stands free, or another that is taken out with over twice as many.
        """
        takers, holders = self.takers, self.held_at
        if len(takers) == 1:
            return [False] * len(self.around)
        n = range(1, len(takers))
        words, plain_words, clear = [0] * len(takers), [0] * len(takers), [0] * len(takers)
        firm = [False] * len(takers)  # whether anything that cannot be a wrapper is in the list
        for i in n:
            outside, _, wrapper, _ = takers[i]
            firm[i] = firm[outside] or not (wrapper or i in holders)
        for at, kind, count in zip(self.around, self.kinds, self.counts, strict=True):
            if count:
                words[at] += count
                if not firm[at] and kind != "w:a":
                    plain_words[at] += count
        own = words[:]
        for i in reversed(n):  # a list's number is above that of the list outside
            words[takers[i][0]] += words[i]
            plain_words[takers[i][0]] += plain_words[i]
        has_holder = [i in holders for i in range(len(takers))]
        for i in reversed(n):
            has_holder[takers[i][0]] |= has_holder[i]
        in_holder = [False] * len(takers)
        free = [True] * len(takers)  # whether no element of the list takes out
        for i in n:
            outside = takers[i][0]
            in_holder[i] = in_holder[outside] or i in holders
            free[i] = free[outside] and i in holders
        some_free = any(free[i] for i in holders)
        out, hidden = [False] * len(takers), [False] * len(takers)
        plain = set()
        for i in n:
            outside, token, wrapper, hides = takers[i]
            hidden[i] = hidden[outside] or hides
            if wrapper and plain_words[i] * 2 > plain_words[0] and (has_holder[i] or in_holder[i] or not some_free):
                plain.add(i)
                self.kinds[token] = self.kinds[token].rstrip("!")
            out[i] = out[outside] or not (i in plain or i in holders)
        for i in reversed(n):
            clear[i] += 0 if out[i] else own[i]
            clear[takers[i][0]] += clear[i]
        most_free = max((clear[i] for i in holders if not out[i]), default=0)
        most = max((words[i] for i in holders if out[i] and not hidden[i]), default=0)
        for i in n:
            if i in holders:
                out[i] = out[takers[i][0]] and (hidden[i] or words[i] <= most_free or words[i] * 2 < most)
            else:
                out[i] = out[takers[i][0]] or i not in plain
        return [out[i] for i in self.around]

    def scores(self, weights: dict[str, float]) -> list[float]:
        """Of each token; words that are out of any article score nothing."""
        return [
            (0.0 if out else n * weights.get(kind, WORD)) if kind.startswith("w:") else weights.get(kind, MARK)
            for kind, n, out in zip(self.kinds, self.counts, self.out, strict=True)
        ]

    def text(self, weights: dict[str, float]) -> str:
        first, last = best_run(self.scores(weights))
        chosen = range(first, last)
        holders = {self.holder[i] for i in chosen if self.counts[i]}
        if len(holders) == 1 and 0 not in holders:  # within one article: all of it
            chosen = [i for i, holder in enumerate(self.holder) if holder in holders]
        parts: dict[int, list[str]] = {}
        for i in chosen:
            if self.texts[i] and not self.out[i]:
                parts.setdefault(self.block[i], []).append(self.texts[i])
        blocks = (" ".join("".join(part).split()) for part in parts.values())
        return "\n".join(b for b in blocks if b)


def best_run(scores: list[float]) -> tuple[int, int]:
    """The run [first, last) with the largest sum, the earliest of equal ones; (0, 0) if no score is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def counted(sources: list[str]) -> Counter:
    """How many words or tags of each kind stand inside and outside of the article, over pages that name one."""
    counts: Counter = Counter()
    for source in sources:
        page = Page(source)
        if page.articles == 1:
            for kind, n, inside, out in zip(page.kinds, page.counts, page.inside, page.out, strict=True):
                counts[kind, inside and not out] += n if kind.startswith("w:") else 1
    return counts


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of standing in the article: of words at least ``LEAST``, of tags at most ``-LEAST``."""
    weights = {}
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 1) / (counts.get((kind, False), 0) + 1))
        weights[kind] = max(LEAST, min(MOST, odds)) if kind.startswith("w:") else min(-LEAST, max(-MOST, odds))
    return weights


def learned(pages: DataFrame, kinds: int = 2000) -> dict[str, float]:
    """Weights from all pages with exactly one ``article``; of the kinds, the ``kinds`` most frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = counted([t.decode() for t in texts_of(batch, "html")])
            columns = [pa.array([k for k, _ in counts], pa.string()), pa.array([i for _, i in counts], pa.bool_()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "inside", "n"])

    total = pages.select("html").mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind")
    total = total.agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("here"), F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("there"))
    rows = total.orderBy((F.col("here") + F.col("there")).desc(), "kind").limit(kinds).collect()
    return weights_of({(r["kind"], side): r[name] for r in rows for side, name in ((True, "here"), (False, "there"))})


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each row of ``pages``.

    Null or empty html, and pages without words, give an empty text. Without pages that name their article
    words score 1 and tags -3.25. Repeated rows get a row each. Other columns are ignored. No rows give none.
    """
    weights = learned(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(t.decode()).text(weights) for t in texts_of(batch, "html")]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
