"""Main text of web pages, with a suffix array of each host's token streams for what markup does not settle.

Markup first: scripts, styles, comments and tags go, as does what stands in
navigation, headers, footers, sidebars, forms and elements named as adverts,
notices or reader comments. A marked article (or main part) holds the text.

Then the token streams of a host's pages are compared, those with a marked
article and those without apart. A suffix is taken where a run of boilerplate
may begin: at each sentence of a marked article, elsewhere at marks, runs of
five tokens chosen by their hash. It is followed up only if enough pages share
its first tokens and no left neighbour is common to more than half of them, as
it would be in copies of one text. What is left is sorted by Spark; the common
prefixes of neighbours give the substrings that several pages hold, and such a
run is boilerplate if its right neighbours differ as well. Of a marked article
only whole sentences go, so a copied article, headline or paragraph stays.
"""

from __future__ import annotations

import hashlib
import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .words import U, byte_view, mix, slices, word_hashes

#: A run is long from so many tokens and common to a host from so many pages; suffixes are compared ``CHUNK`` tokens at a time.
MIN_TOKENS, PAGES, CHUNK = 8, 3, 256
#: Later chunks of long common suffixes are twice as long as those before, up to this; fewer of them meet in a task.
MAX_CHUNK = 2_048
#: Tokens of a mark, and in how many runs that begin one after another the mark is the one of least hash: equal tokens have equal marks.
MARK = 5
_CHOICE = MIN_TOKENS - MARK + 1
#: Suffixes with the same first tokens that one task takes; more of them are told apart by longer prefixes first.
GROUP = 4_096

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|textarea|select|title)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*+>"
    r"|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
#: Inline elements do not end a block; void ones have no end tag.
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag may be left out, and the siblings that end them; lists and tables hold their own.
_ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "tr": {"tr", "tbody", "thead", "tfoot"}, "tbody": {"tbody", "thead", "tfoot"}, "thead": {"tbody", "tfoot"}, "tfoot": {"tbody", "thead"},
}
_HOLDERS = set("ul ol dl table menu".split())
#: Elements and names that mark what is not the text.
_ASIDE = set("nav header footer aside menu dialog button head fieldset object audio video canvas map".split())
_ASIDE_NAMES = set(
    "ad ads advert adverts advertisement sponsored promo promotion sidebar cookie cookies consent notice banner comment comments "
    "reply replies discussion disqus share sharing social related breadcrumb breadcrumbs menu nav navigation navbar footer header masthead "
    "popup modal overlay newsletter subscribe signup login search pagination pager widget toolbar contentinfo complementary".split()
)
_COMMENT = re.compile(r"(?:comments?|repl(?:y|ies)|discussion|disqus)(?:[-_]?(?:\d+|body|content|text|list|thread))?")
_BODY = {"article", "main"}
#: What ends a sentence, and what may stand behind that.
_STOPS, _CLOSING = (".", "!", "?", "…", "。", "！", "？"), "\"'”’»)]"

#: Whether an element is set aside: never, unless it holds most of the text, unless that is an article as well, always.
_NO, _UNLESS_MOST, _UNLESS_ARTICLE, _ALWAYS = range(4)


def _aside(tag: str, attributes: str) -> int:
    """By the element's own name, else by class, id and role: a name in full, or its first or last word."""
    if tag in _ASIDE:
        return _ALWAYS
    found = _UNLESS_ARTICLE if tag == "form" else _NO
    if not attributes or tag in ("html", "body", "main"):
        return found
    for match in _NAMES.finditer(attributes):
        for name in (match[1] or match[2] or match[3] or "").lower().split():
            if _COMMENT.fullmatch(name):
                return _ALWAYS
            words = re.split("[_-]+", name)
            if tag != "article" and _ASIDE_NAMES.issuperset(words):
                found = _UNLESS_ARTICLE
            elif tag != "article" and (words[0] in _ASIDE_NAMES or words[-1] in _ASIDE_NAMES):
                found = found or _UNLESS_MOST
    return found


class _Page:
    """Elements of a page as a tree, and the blocks of text they hold."""

    def __init__(self) -> None:
        self.parent, self.tag, self.aside = [0], [""], [_NO]
        self.blocks: list[tuple[int, str]] = []
        self.stack = [0]
        self.hidden = [False]

    def open(self, tag: str, aside: int) -> None:
        self.parent.append(self.stack[-1])
        self.tag.append(tag)
        self.aside.append(aside)
        self.hidden.append(self.hidden[self.stack[-1]] or aside == _ALWAYS)
        self.stack.append(len(self.tag) - 1)

    def end_open(self, tag: str) -> None:
        """Ends what a start tag ends: an open paragraph, and siblings whose end tag was left out."""
        stack = self.stack
        place = len(stack) - 1
        while place and self.tag[stack[place]] in _INLINE:
            place -= 1
        if self.tag[stack[place]] == "p":
            del stack[place:]
        if tag not in _SIBLINGS:
            return
        for place in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[place]]
            if name in _HOLDERS:
                return
            if tag in _ENDED_BY.get(name, ()):
                del stack[place:]
                # A row ends its cells and itself.
                if tag not in _ENDED_BY.get(self.tag[stack[-1]], ()):
                    return

    def close(self, tag: str) -> None:
        for place in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[place]] == tag:
                del self.stack[place:]
                return

    def texts(self) -> tuple[list[str], list[str], bool]:
        size = [0] * len(self.tag)
        holds = [tag in _BODY and not hidden for tag, hidden in zip(self.tag, self.hidden)]
        for node, text in self.blocks:
            size[node] += len(text)
        for node in range(len(size) - 1, 0, -1):
            size[self.parent[node]] += size[node]
            holds[self.parent[node]] |= holds[node]
        out, article = [False] * len(size), [False] * len(size)
        for node in range(1, len(size)):
            up, aside = self.parent[node], self.aside[node]
            spared = 2 * size[node] > size[0] and (aside == _UNLESS_MOST or holds[node])
            out[node] = out[up] or aside == _ALWAYS or (aside != _NO and not spared)
            article[node] = not out[node] and (article[up] or self.tag[node] in _BODY)
        inside = [text for node, text in self.blocks if article[node]]
        outside = [text for node, text in self.blocks if not article[node] and not out[node]]
        return inside, outside, any(article)


_SIBLINGS = set().union(*_ENDED_BY.values())


def blocks(page: str) -> tuple[list[str], list[str], bool]:
    """Blocks of the marked article, all blocks outside it that are not set aside, and whether there is an article.

    A closing tag closes what it names and all that is open inside; one
    without a start is passed over; what is never closed ends with its parent,
    paragraphs, items and cells also where the next one begins. An element
    whose class, id or role names something that is not the text is set aside
    unless it holds more than half of the page's text, so a wrapper called
    after the sidebar next to the article is no sidebar.
    """
    tree = _Page()
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text and not tree.hidden[tree.stack[-1]]:
                tree.blocks.append((tree.stack[-1], text))

    for token in _TOKEN.finditer(page):
        tag = token[3]
        if tag is None:
            piece = token[0]
            if piece[0] != "<" or piece == "<":
                pieces.append(html.unescape(piece))
            elif token[1]:
                flush()
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
            continue
        top = tree.tag[tree.stack[-1]]
        if tag in _INLINE:
            if token[2]:
                if top == tag:
                    flush()
                    tree.stack.pop()
                continue
            aside = _aside(tag, token[4])
            if aside:
                flush()
            if aside or top == tag:
                tree.open(tag, aside)
            continue
        flush()
        if token[2]:
            tree.close(tag)
            continue
        tree.end_open(tag)
        if tag not in _VOID and not (token[4].endswith("/") and tag not in _BODY):
            tree.open(tag, _aside(tag, token[4]))
    flush()
    return tree.texts()


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``edges`` are where the sentences of a marked article begin, else where the blocks do."""
    for batch in batches:
        rows = []
        for page in batch["html"]:
            inside, outside, marked = blocks(page or "")
            stream = inside if marked else outside
            edges = set(itertools.accumulate((block.count(" ") + 1 for block in stream), initial=0))
            text = " ".join(stream)
            if marked:
                edges |= {k + 1 for k, token in enumerate(text.split(" ")) if token.rstrip(_CLOSING).endswith(_STOPS)}
            rows.append((marked, text, sorted(edges)[:-1]))
        found = pd.DataFrame(rows, columns=["marked", "stream", "edges"], index=batch.index)
        yield pd.concat([batch[["row_no", "page_id", "url"]], found], axis=1)


def _unique_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, counts = [], []
        for marked, stream, edges, runs in zip(*(batch[c] for c in ("marked", "stream", "edges", "runs"))):
            tokens = stream.split(" ")
            keep = [True] * len(tokens)
            for run in runs if runs is not None else ():
                keep[run["start"] : run["end"]] = [False] * (run["end"] - run["start"])
            counts.append(sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep)))
            if counts[-1]:
                (_spare_sentences if marked else _spare_edges)(keep, edges)
            # A page that is covered whole is a copy of a page, not boilerplate.
            texts.append(" ".join(t for t, k in zip(tokens, keep) if k) if any(keep) else stream)
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_repeated": counts})


def _spare_edges(keep: list[bool], edges: list[int]) -> None:
    """A repeat that runs over into a block covers its first tokens by chance: short runs in a block that has others are kept."""
    for begin, end in zip(edges, [*edges[1:], len(keep)]):
        own = keep[begin:end]
        if not any(own) or all(own):
            continue
        at = begin
        for covered, run in itertools.groupby(own, key=lambda k: not k):
            size = len(list(run))
            if covered and size < MIN_TOKENS:
                keep[at : at + size] = [True] * size
            at += size


def _spare_sentences(keep: list[bool], edges: list[int]) -> None:
    """In a marked article only whole sentences go."""
    for begin, end in itertools.pairwise([*edges, len(keep)]):
        if any(keep[begin:end]):
            keep[begin:end] = [True] * (end - begin)


def _chain(seed: np.ndarray, hashes: np.ndarray, at: np.ndarray, tokens: int) -> np.ndarray:
    """Hash of the ``tokens`` words from each place on."""
    for k in range(tokens):
        seed = mix(seed + hashes[at + k])
    return seed


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, around, first, row_no, at`` of every place where a run may begin, from number, group, kind, stream and edges of a page.

    ``key`` stands for the first tokens, ``around`` for what precedes them: one
    token at a sentence, where the article's begin is like any other token, and
    as many as a run may have before its first mark elsewhere, where the begin
    of each page is its own. ``first`` is false where the page had the key before.
    """
    for batch in batches:
        content, bounds = byte_view(batch.column(3))
        rows, groups, marked = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        edges = batch.column(4).to_pylist()
        for low, high in slices(bounds):
            hashes, _, first = word_hashes(content, bounds[low : high + 1])
            owner = np.repeat(np.arange(high - low), np.diff(first))
            of_host = groups[low:high].view(U)
            sentence = [first[k - low] + np.asarray(edges[k], np.int64) for k in range(low, high) if marked[k] and len(edges[k])]
            sentence = np.concatenate([*sentence, np.zeros(0, np.int64)])
            sentence = sentence[sentence < len(hashes)]
            sentence = sentence[sentence + MIN_TOKENS <= first[1:][owner[sentence]]]
            before = np.where(sentence > first[owner[sentence]], hashes[np.maximum(sentence - 1, 0)], U(0))
            found = [(_chain(of_host[owner[sentence]], hashes, sentence, MIN_TOKENS), mix(before), sentence)]

            begin = np.flatnonzero(~marked[low:high][owner] & (np.arange(len(hashes)) + MIN_TOKENS <= first[1:][owner]))
            if len(begin):
                runs = np.zeros(len(hashes), U)
                whole = np.arange(len(hashes) - MARK + 1)
                runs[whole] = _chain(of_host[owner[whole]], hashes, whole, MARK)
                at = np.unique(begin + np.argmin([runs[begin + k] for k in range(_CHOICE)], axis=0))
                before = np.zeros(len(at), U)
                for k in range(1, _CHOICE + 1):
                    inside = at - k >= first[owner[at]]
                    before = mix(before + np.where(inside, hashes[np.maximum(at - k, 0)], mix(rows[low + owner[at]].view(U) + U(k))))
                found.append((runs[at], before, at))
            key, around, at = (np.concatenate(c) for c in zip(*found))
            if not len(at):
                continue
            order = np.lexsort((at, key, owner[at]))
            key, around, at = key[order], around[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = (key[1:] != key[:-1]) | (owner[at[1:]] != owner[at[:-1]])
            columns = [key.view(np.int64), around.astype(np.uint32).view(np.int32), new, rows[low + owner[at]], (at - first[owner[at]]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "around", "first", "row_no", "at"])


def _no_majority(counts: DataFrame, by: str, n: str = "n") -> DataFrame:
    """The values of ``by`` that enough pages have, of whose rows none has more than half."""
    per_value = counts.groupBy(by).agg(F.sum(n).alias("n"), F.max(n).alias("most"))
    return per_value.filter((F.col("n") >= PAGES) & (2 * F.col("most") <= F.col("n"))).select(by)


def _digest(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode(), digest_size=8).digest(), "big", signed=True)


def _suffixes(skip: int, chunk: int):
    """``chunk`` tokens of the suffix at each place, behind its first ``skip``, whether it goes on, and hashes of the 1, 2, ... tokens before it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row_no, marked, stream, places in zip(*(batch[c] for c in ("row_no", "marked", "stream", "places"))):
                tokens = stream.split(" ")
                for place in places:
                    at = place["at"]
                    lefts = []
                    for k in range(1, 2 if marked else _CHOICE + 1):
                        edge = [] if at >= k else ["", "" if marked else str(row_no)]
                        lefts.append(_digest(str(k), *edge, *tokens[max(at - k, 0) : at]))
                    suffix = tokens[at + skip : at + skip + chunk]
                    more = at + skip + len(suffix) < len(tokens)
                    # The end of an article is like any other token, that of another page is its own.
                    if not more:
                        suffix.append("" if marked else f" {row_no}")
                    rows.append((place["key"], row_no, at, place["first"], lefts, more, "\n".join(suffix)))
            yield pd.DataFrame(rows, columns=["key", "row_no", "at", "first", "lefts", "more", "suffix"])

    return run


_SUFFIX = "key long, row_no long, at int, first boolean, lefts array<long>, more boolean, suffix string"
_MEMBERS = "key long, node long, depth int, row_no long, at int, first boolean, lefts array<long>"


def _common(a: list[str], b: list[str]) -> int:
    """Length of the common prefix in tokens."""
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def shared_prefixes(suffixes: list[list[str]], first: list[bool]) -> Iterator[tuple[int, int, int]]:
    """``begin, end, depth`` of the stretches of sorted suffixes that share ``depth`` tokens and no majority the next one.

    These are inner nodes of the suffix tree, read off the common prefixes of
    neighbours; suffixes that are not ``first`` in their page do not count.
    """
    counted = list(itertools.accumulate(first, initial=0))
    open_: list[tuple[int, int]] = []
    for at in range(1, len(suffixes) + 1):
        shared = _common(suffixes[at - 1], suffixes[at]) if at < len(suffixes) else 0
        begin = at - 1
        while open_ and open_[-1][1] > shared:
            begin, depth = open_.pop()
            n = counted[at] - counted[begin]
            if n >= PAGES:
                following = Counter(s[depth] if depth < len(s) else None for s, f in zip(suffixes[begin:at], first[begin:at]) if f)
                # None: the suffix ends there, or goes on in its next chunk, which begins with the token before.
                if None not in following and 2 * max(following.values()) <= n:
                    yield begin, at, depth
        if shared and (not open_ or open_[-1][1] < shared):
            open_.append((begin, shared))


def _in_order(skip: int, least: int):
    """Rows of :data:`_MEMBERS` from suffixes behind ``skip`` tokens, sorted by key and text; at most ``GROUP`` have one key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in itertools.chain(batches, [None]):
            table = batch if held is None else held if batch is None else pd.concat([held, batch], ignore_index=True)
            if table is None or not len(table):
                held = table
                continue
            keys = table["key"].to_numpy()
            cut = len(keys) if batch is None else int(np.flatnonzero(keys == keys[-1])[0])
            held = table.iloc[cut:].reset_index(drop=True)
            rows = []
            for key, group in table.iloc[:cut].groupby("key", sort=False):
                texts = [s.split("\n") for s in group["suffix"]]
                members = list(zip(group["row_no"], group["at"], group["first"], group["lefts"]))
                for begin, end, depth in shared_prefixes(texts, list(group["first"])):
                    if depth >= least:
                        node = _digest(str(key), *texts[begin][:depth])
                        rows += [(key, node, skip + depth, *member) for member in members[begin:end]]
            if rows:
                yield pd.DataFrame(rows, columns=["key", "node", "depth", "row_no", "at", "first", "lefts"])

    return run


def _prefixes(skip: int, low: int, high: int):
    """``node, depth, next`` and the place of each prefix of ``low`` to below ``high`` tokens behind the first ``skip`` of a suffix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, row_no, at, first, lefts, suffix in zip(*(batch[c] for c in ("key", "row_no", "at", "first", "lefts", "suffix"))):
                tokens = suffix.split("\n")
                for depth in range(low, min(high, len(tokens))):
                    rows.append((key, _digest(str(key), *tokens[:depth]), skip + depth, row_no, at, first, lefts, _digest(tokens[depth])))
            yield pd.DataFrame(rows, columns=["key", "node", "depth", "row_no", "at", "first", "lefts", "next"])

    return run


def _at_depths(skip: int):
    """The prefixes of the given depths, as :data:`_MEMBERS`, of suffixes behind ``skip`` tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, row_no, at, first, lefts, suffix, depths in zip(*(batch[c] for c in ("key", "row_no", "at", "first", "lefts", "suffix", "depths"))):
                tokens = suffix.split("\n")
                for depth in depths:
                    if depth - skip <= len(tokens):
                        rows.append((key, _digest(str(key), *tokens[: depth - skip]), depth, row_no, at, first, lefts))
            yield pd.DataFrame(rows, columns=["key", "node", "depth", "row_no", "at", "first", "lefts"])

    return run


def _longer_keys(tokens: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [s.split("\n") for s in batch["suffix"]]
            batch = batch.assign(key=[_digest(str(k), *t[:tokens]) for k, t in zip(batch["key"], texts)])
            yield batch[[len(t) > tokens for t in texts]]

    return run


def _members(suffixes: DataFrame, group: int = GROUP, skip: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The places of every shared prefix without a majority behind it, as :data:`_MEMBERS`.

    Which prefixes these are follows from the first suffix of each page alone, so a page that repeats a few tokens over
    and over weighs no more than another; its later suffixes are looked up at the depths found. Keys with more than
    ``group`` pages never meet in a task: their prefixes of up to twice the length known to be common are counted, with
    partial sums before the shuffle, and what is longer goes on under a key of that length.
    """
    # Suffixes of a key share its mark, behind the first chunk the last token of the chunk before.
    least = 1 if skip else MARK
    leading, later = suffixes.filter("first"), suffixes.filter("not first")
    parts, tokens = [], least
    while True:
        many = materialize(leading.groupBy("key").count().filter(F.col("count") > group).select("key"), "frequent")
        hot = not many.isEmpty()
        few = leading.join(many, "key", "left_anti").select(leading.columns) if hot else leading
        found = few.repartition("key").sortWithinPartitions("key", "suffix", "row_no", "at").mapInPandas(_in_order(skip, least), _MEMBERS)
        more = hot and tokens < chunk
        if more:
            often = leading.join(many, "key", "left_semi").select(leading.columns)
            counted = often.mapInPandas(_prefixes(skip, tokens, min(2 * tokens, chunk)), f"{_MEMBERS}, next long")
            nodes = _no_majority(counted.groupBy("node", "next").agg(F.count("*").alias("n")), "node")
            found = found.unionByName(counted.drop("next").join(nodes, "node", "left_semi"))
        found = materialize(found, "members")
        depths = found.groupBy("key").agg(F.collect_set("depth").alias("depths"))
        looked_up = later.join(depths, "key").mapInPandas(_at_depths(skip), _MEMBERS)
        parts += [found, looked_up.join(found.select("node").distinct(), "node", "left_semi").select(found.columns)]
        if not more:
            break
        tokens *= 2
        leading = materialize(often.mapInPandas(_longer_keys(tokens), suffixes.schema), "suffixes")
        later = later.join(many, "key", "left_semi").select(later.columns)
        later = materialize(later.mapInPandas(_longer_keys(tokens), suffixes.schema), "suffixes")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole.drop("key")


def repeated_runs(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """``row_no, start, end`` of the boilerplate in ``row_no, host, marked, stream, edges``, in tokens.

    A run is boilerplate if at least ``PAGES`` pages of the host hold it, and
    neither its left nor its right neighbour is the same in more than half of
    them. Of the runs that begin at one place the longest is given. A page
    counts once for a run. Keys are hashes, the tokens themselves are compared.
    """
    starts = pages.select("row_no", F.xxhash64("host", "marked"), "marked", "stream", "edges").mapInArrow(
        _starts, "key long, around int, first boolean, row_no long, at int"
    )
    keys = materialize(_no_majority(starts.filter("first").groupBy("key", "around").agg(F.count("*").alias("n")), "key"), "keys")
    places = starts.join(keys, "key").groupBy("row_no").agg(F.collect_list(F.struct("key", "at", "first")).alias("places"))
    places = materialize(places, "places")
    members, skip, chunk = None, 0, CHUNK
    while True:
        suffixes = materialize(pages.join(places, "row_no").mapInPandas(_suffixes(skip, chunk), _SUFFIX), "suffixes")
        found = materialize(_members(suffixes, max(group * CHUNK // chunk, 1), skip, chunk), "members")
        members = found if members is None else members.union(found)
        # Suffixes that share a whole chunk with enough pages are followed to its next, which begins with the last token of this one.
        longer = suffixes.filter("more").select(F.xxhash64("key", "suffix").alias("key"), "row_no", "at", "first")
        keys = longer.filter("first").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= PAGES).select("key")
        places = longer.join(keys, "key").groupBy("row_no").agg(F.collect_list(F.struct("key", "at", "first")).alias("places"))
        places = materialize(places, "places")
        if places.isEmpty():
            break
        skip, chunk = skip + chunk - 1, min(2 * chunk, MAX_CHUNK)

    # How many tokens before the suffix more than half of its pages have too; if all that were looked at, the run begins elsewhere.
    before = members.filter("first").select("node", F.size("lefts").alias("looked"), F.posexplode("lefts").alias("k", "left"))
    before = before.groupBy("node", "k", "left").agg(F.count("*").alias("n"), F.max("looked").alias("looked"))
    per_k = before.groupBy("node", "k").agg(F.max("looked").alias("looked"), F.sum("n").alias("n"), F.max(F.struct("n", "left")).alias("top"))
    common = F.when(2 * F.col("top.n") > F.col("n"), F.col("top.left"))
    nodes = per_k.groupBy("node").agg(F.max("looked").alias("looked"), F.collect_list(common).alias("shared"))
    nodes = nodes.filter(F.size("shared") < F.col("looked")).select("node", "shared")
    extra = F.size(F.array_intersect("lefts", "shared"))
    runs = members.join(nodes, "node").select("row_no", "at", (F.col("at") - extra).alias("start"), (F.col("at") + F.col("depth")).alias("end"))
    runs = runs.filter(F.col("end") - F.col("start") >= MIN_TOKENS)
    return runs.groupBy("row_no", "at").agg(F.max(F.struct("end", "start")).alias("run")).select("row_no", "run.start", "run.end")


def host_of(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", content: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_repeated`` for every row of ``pages``.

    ``text`` is the main text with its blocks in page order, white space inside
    them one space, blocks joined by one; empty where there is none, so also
    for null or empty pages. ``n_repeated`` counts the runs of boilerplate found
    in it, also those that are no whole sentence. Pages with a null url are one
    host. Repeated rows are pages of their own. Where no article is marked, the
    begin and the end of a page are taken to differ from those of others, and a
    page that is covered whole is kept.
    """
    # Ids go through pandas as text, which has a null.
    rows = pages.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(page_id).cast("string").alias("page_id"), F.col(url).alias("url"), F.col(content).alias("html")
    )
    schema = "row_no long, page_id string, url string, marked boolean, stream string, edges array<int>"
    path = scratch_path(pages.sparkSession, "pages")
    rows.mapInPandas(_parsed, schema).write.option("compression", "zstd").parquet(path)
    parsed = pages.sparkSession.read.schema(schema).parquet(path)
    runs = repeated_runs(parsed.select("row_no", host_of().alias("host"), "marked", "stream", "edges"))
    per_page = materialize(runs.groupBy("row_no").agg(F.collect_list(F.struct("start", "end")).alias("runs")), "runs")
    joined = parsed.join(per_page, "row_no", "left")
    done = joined.mapInPandas(_unique_runs, "page_id string, url string, text string, n_repeated long")
    return done.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
