"""Held-out items leaking into training documents: a stored positional inverted index, partitioned by document.

Terms are runs of ANCHOR characters of the bare text (letters and digits in one case and width), the shortest runs that count
as agreeing. One scan of the documents writes their positional postings, shard by shard (a shard is about SEGMENT_CHARS
characters of documents): for every term that some item has, the places where it stands. Items are then searched in the
stored index only, in blocks of bounded size. In a shard an item's lists are intersected from the rarest term on: as many of
its commonest places are left out at first as every passage can spare, and only texts that hold enough of the rest get all
their lists. A pair goes on while the places covered, adjusted by offset, could still make up the least passage wanted, in
number and in density; these bounds hold for every passage that the alignment accepts, so none is lost. What is left is
aligned place by place from the postings, which gives exact and proximity matches; no text is read twice.

Lists are partitioned by document and not by term because a term's list would have to be joined with every item that has the
term: see README for the figures.
"""

import unicodedata
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatemill.plans.cut import cut

ANCHOR, TABLE = 4, 1 << 22
#: Item places posted at a time by a task.
POSTS = 1_000_000
#: Items of fewer bare characters match nothing: a phrase of a few words is no leak.
LEAST = 16
_P = np.uint64(0x9E3779B97F4A7C15)
#: Characters of items searched in one pass over the stored index; larger sets are searched in blocks of this size, which bounds what is broadcast.
BLOCK_CHARS = 2_000_000
#: Characters of documents in one shard of the index.
SEGMENT_CHARS = 400_000


@cache
def folded() -> np.ndarray:
    """Code point to its bare form, 0 for characters that do not count; look-alike widths and cases share one form."""
    out = np.zeros(0x110000, np.uint32)
    for code in [*range(0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x2F800, 0x2FA20)]:
        kept = [c for c in unicodedata.normalize("NFKC", chr(code)).casefold() if c.isalnum()]
        if kept and not 0xD800 <= code < 0xE000:
            out[code] = ord(kept[0])
    for low, high in ((0x3400, 0xA000), (0xAC00, 0xD7A4), (0x20000, 0x2F800), (0x30000, 0x32000)):
        out[low:high] = np.arange(low, high)
    return out


def bare(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bare characters of all texts in a row, and for each text where it begins there (one more entry than texts)."""
    texts = pc.fill_null(texts, "")
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    codes = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    form = folded()[codes]
    kept = np.r_[0, np.cumsum(form != 0)]
    return form[form != 0], kept[np.r_[0, np.cumsum(lengths)]]


def rolled(codes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k characters in a row."""
    m = len(codes) - k + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = codes[:m].astype(np.uint64)
    for j in range(1, k):
        out = out * _P + codes[j : j + m]
    return out ^ (out >> np.uint64(29))


class Items:
    """The items' bare texts, their terms and where each term stands."""

    def __init__(self, ids: list[str], texts: list[str]):
        self.ids = ids
        codes, self.start = bare(pa.array(texts, pa.string()))
        self.codes = codes
        hashes = rolled(codes, ANCHOR)
        owner = np.searchsorted(self.start, np.arange(len(hashes)), "right") - 1
        whole = np.arange(len(hashes)) + ANCHOR <= self.start[owner + 1] if len(hashes) else np.empty(0, bool)
        self.hash, self.owner, self.at = hashes[whole], owner[whole], (np.arange(len(hashes)) - self.start[owner])[whole] if len(hashes) else np.empty(0, np.int64)
        self.terms, many = np.unique(self.hash, return_counts=True)
        # owner and place of each term's occurrences, term by term from first on
        order = np.argsort(self.hash, kind="stable")
        self.first, self.owner_of, self.at_of = np.r_[0, np.cumsum(many)], self.owner[order], self.at[order]
        self.term_of = np.repeat(np.arange(len(self.terms)), many)

    def length(self, item: int) -> int:
        return int(self.start[item + 1] - self.start[item])

    @cached_property
    def _own(self) -> tuple[np.ndarray, np.ndarray]:
        """Each term by item, and where the items begin there."""
        return np.searchsorted(self.terms, self.hash), np.searchsorted(self.owner, np.arange(len(self.ids) + 1))

    def met(self, item: int, at: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the text, place in the item) of the item's terms among a text's (places at, in order; term: place in terms)."""
        own, edges = self._own
        own = own[edges[item] : edges[item + 1]]
        order = np.argsort(own, kind="stable")
        own = own[order]
        mine = np.zeros(len(self.terms), bool)
        mine[own] = True
        kept = mine[term]
        at, term = at[kept], term[kept]
        low = np.searchsorted(own, term)
        many = np.searchsorted(own, term, "right") - low
        return np.repeat(at, many), order[np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)]


def mark(table: np.ndarray, terms: np.ndarray) -> None:
    """Notes the terms in a table of TABLE bits. Whatever the number of items, it has this size; a full one only makes the index larger."""
    table[(terms & np.uint64(TABLE - 1)).astype(np.int64)] = True


def postings(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The stored index of documents (doc_id, text): a row a shard with its documents, where each begins, and the sorted terms with their places.

    wanted: bits of the terms that are posted, by hash. doc: ids; start: first place of each document; term: hashes; n: places
    of each term; step: the places of the first term, then of the next, each as the difference from the one before.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted).tobytes())
    kinds = {"doc": pa.list_(pa.int64()), "start": pa.list_(pa.int32()), "term": pa.list_(pa.int64()), "n": pa.list_(pa.int32()), "step": pa.list_(pa.int32())}

    def post(batches):
        table = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for base, _, start, hashes, _, inside in segments(batch, 1):
                at = np.flatnonzero(table[(hashes & np.uint64(TABLE - 1)).astype(np.int64)] & inside)
                if len(at):
                    order = np.argsort(hashes[at], kind="stable")
                    term, n = np.unique(hashes[at], return_counts=True)
                    row = ids[base : base + len(start) - 1], start[:-1].astype(np.int32), term.view(np.int64), n.astype(np.int32), np.diff(at[order], prepend=0).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kinds[k].value_type)) for k, x in zip(kinds, row)], names=[*kinds])

    return cut(docs.select("doc_id", "text").mapInArrow(post, "doc array<bigint>, start array<int>, term array<bigint>, n array<int>, step array<int>"))


def in_shard(items: "Items", term: np.ndarray, n: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the shard, place in items.terms) of the items' terms, in the order of places."""
    place = np.minimum(np.searchsorted(items.terms, term), len(items.terms) - 1)
    known = items.terms[place] == term
    at = np.cumsum(step, dtype=np.int64)
    mine = np.repeat(known, n)
    at, place = at[mine], np.repeat(place[known], n[known])
    order = np.argsort(at, kind="stable")
    return at[order], place[order]


def segments(batch, text_column: int):
    """(first row, bare codes, starts, hashes, row of each hash) of runs of rows of about SEGMENT_CHARS characters."""
    lengths = pc.fill_null(pc.utf8_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lengths) // SEGMENT_CHARS
    edges = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(lengths)] if len(lengths) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        codes, start = bare(batch.column(text_column).slice(a, b - a))
        hashes = rolled(codes, ANCHOR)
        row = np.repeat(np.arange(b - a), np.diff(start))[: len(hashes)]
        inside = np.arange(len(hashes)) + ANCHOR <= start[row + 1]
        yield int(a), codes, start, hashes, row, inside


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, each key's place among them and their counts."""
    low = key.min() if len(key) else 0
    if len(key) * 4 + 1024 < key.max(initial=0) - low:
        return np.unique(key, return_inverse=True, return_counts=True)
    n = np.bincount(key - low)
    held = np.flatnonzero(n)
    where = np.cumsum(n > 0) - 1
    return held + low, where[key - low], n[held]


def could_hold(row: np.ndarray, term: np.ndarray, items: Items, share: float, agreement: float) -> np.ndarray:
    """Pairs row * number of items + item whose text may hold a passage; row and term (place in items.terms), sorted and each pair once: the terms in the texts.

    A passage has this share of the item and agrees as wanted, so in some stretch of the item of that share or more the text's
    terms must cover that part of the places. A term covers ANCHOR places, which tells how many places of an item must be met
    at least; half as many, its commonest ones in these texts, are first left out.
    """
    count, lengths = len(items.ids), np.diff(items.start)
    need = np.maximum(np.ceil((agreement * share * lengths - 1e-6) / ANCHOR).astype(np.int64), 1)
    # an item's places from its commonest term on
    texts = np.bincount(term, minlength=len(items.terms))
    common = texts[items.term_of]
    order = np.lexsort((-common, items.owner_of))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order)) - np.searchsorted(items.owner_of[order], np.arange(count))[items.owner_of[order]]
    spared = rank < (need // 2)[items.owner_of]

    def post(rows, terms, of):
        first = of[1][terms]
        many = of[1][terms + 1] - first
        place = of[0][np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)]
        return np.repeat(rows, many) * np.int64(count) + items.owner_of[place], place

    def lists(chosen):
        return np.flatnonzero(chosen), np.r_[0, np.cumsum(chosen)][items.first]

    key, post_at = post(row, term, lists(~spared))
    pair, place, met = _counted(key)
    left = need - np.minimum(need // 2, lengths)
    alive = met >= left[pair % count]
    kept = alive[place]
    pair, key, post_at = pair[alive], key[kept], post_at[kept]
    if len(pair):
        rows = np.isin(row, pair // count)
        rest, rest_at = post(row[rows], term[rows], lists(spared))
        known = pair[np.minimum(np.searchsorted(pair, rest), len(pair) - 1)] == rest
        key, post_at = np.r_[key, rest[known]], np.r_[post_at, rest_at[known]]
    at = np.sort(key << 32 | items.at_of[post_at])
    if not len(at):
        return at
    key = at >> 32
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    covered = np.minimum(ANCHOR, np.diff(at, prepend=at[0] - ANCHOR))
    size = np.diff(np.r_[begin, len(at)])
    least = share * lengths[key[begin] % count]
    enough = np.add.reduceat(covered, begin) >= agreement * least - 1e-6
    kept = np.repeat(enough, size)
    at, key, covered, size, least = at[kept], key[kept], covered[kept], size[enough], np.repeat(least[enough], size[enough])
    if not len(at):
        return at
    # places covered less the part wanted of all places, before each place as a beginning and after each as an end
    place, total = at & 0xFFFFFFFF, np.cumsum(covered)
    total -= np.repeat(total[np.cumsum(size) - size], size) - ANCHOR
    before = total - ANCHOR - agreement * place
    lower = np.repeat(np.arange(len(size)) * 4.0 * (lengths.max() + ANCHOR), size)
    lowest = np.minimum.accumulate(before - lower) + lower
    from_ = np.searchsorted(at, at + ANCHOR - np.ceil(least - 1e-6).astype(np.int64), "right") - 1
    inside = from_ >= np.repeat(np.cumsum(size) - size, size)
    return np.unique(key[inside & (total - agreement * (place + ANCHOR) - lowest[from_] >= -1e-3)])


def _stretch(there: np.ndarray, least: float, agreement: float) -> bool:
    """Whether in some stretch of at least so many places this part of them is marked."""
    size = max(1, int(np.ceil(least - 1e-6)))
    left = np.r_[0, np.cumsum(there - agreement)]
    return size < len(left) and bool((left[size:] - np.minimum.accumulate(left[: len(left) - size]) >= -1e-6).any())


def passage(p: np.ndarray, q: np.ndarray, length: int, gap: int = 12, insertion: int = 60, least: float = 1, agreement: float = 0) -> tuple[int, int, int]:
    """(begin, end, characters agreeing) of the longest passage of the item in the text, by a local chain of runs that agree.

    p, q: the places in text and item (of this length) of every equal term, by p. Agreement scores 1, each item character left
    out between two runs -3, so a passage agrees to more than three quarters everywhere; up to ``insertion`` foreign characters
    of the text may stand between two runs. least: characters that the passage has at least; agreement: the part of them that agrees.
    """
    best = 0, 0, 0
    # no chain reaches over more foreign characters than one insertion
    edges = np.flatnonzero(np.r_[True, np.diff(p) > insertion + ANCHOR, True]) if len(p) else []
    for s, e in zip(edges[:-1], edges[1:]):
        there = np.zeros(length, bool)
        for k in range(ANCHOR):
            there[q[s:e] + k] = True
        if _stretch(there, least, agreement):
            found = _chain(p[s:e], q[s:e], length, gap, insertion, least, agreement)
            if found[1] - found[0] > best[1] - best[0]:
                best = found
    return best


def _chain(p: np.ndarray, q: np.ndarray, length: int, gap: int, insertion: int, least: float, agreement: float) -> tuple[int, int, int]:
    """The passage of ``passage`` among places without such an insertion."""
    by = np.lexsort((q, p - q))
    p, q = p[by], q[by]
    new = np.flatnonzero(np.r_[True, (np.diff(q) != 1) | (np.diff(p - q) != 0)])
    ends = np.r_[new[1:], len(p)]
    order = np.lexsort((p[new], q[ends - 1], q[new]))
    q0, q1, p0 = q[new][order], q[ends - 1][order] + ANCHOR, p[new][order]
    p1 = p0 + (q1 - q0)
    # which run may follow which
    by = np.argsort(p1, kind="stable")
    low, high = np.searchsorted(p1[by], p0 - insertion), np.searchsorted(p1[by], p0 + ANCHOR - 1, "right")
    many = np.maximum(high - low, 0)
    j = np.repeat(np.arange(len(q0)), many)
    i = by[np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
    fits = (q1[i] <= q0[j] + ANCHOR - 1) & (q0[j] - q1[i] <= gap) & (q0[i] < q0[j])
    i, j = i[fits], j[fits]
    # runs that none follows and that follow none are passages of their own
    linked = q1 - q0 >= least - 1e-6
    linked[i] = linked[j] = True
    there = np.bincount(q0[linked], minlength=length + 1) - np.bincount(q1[linked], minlength=length + 1)
    if not _stretch(np.cumsum(there)[:length] > 0, least, agreement):
        return 0, 0, 0
    over = np.maximum(0, np.maximum(q1[i] - q0[j], p1[i] - p0[j]))
    gained = (q1[j] - q0[j]) - over - 3.0 * np.maximum(0, q0[j] - q1[i]) - np.where(p0[j] - p1[i] > gap, 4.0, 0.0)
    order = np.lexsort((i, j))
    i, gained, over = i[order].tolist(), gained[order].tolist(), over[order].tolist()
    edge = np.r_[0, np.cumsum(np.bincount(j, minlength=len(q0)))].tolist()
    starts, stops = q0.tolist(), q1.tolist()
    score, begin, agree = [float(b - a) for a, b in zip(starts, stops)], starts[:], [b - a for a, b in zip(starts, stops)]
    best = 0, 0, 0
    for k in np.flatnonzero(linked).tolist():
        own = agree[k]
        for x in range(edge[k], edge[k + 1]):
            if score[i[x]] + gained[x] > score[k]:
                score[k], begin[k], agree[k] = score[i[x]] + gained[x], begin[i[x]], agree[i[x]] + own - over[x]
        size = stops[k] - begin[k]
        if size > best[1] - best[0] and size >= least - 1e-6 and agree[k] >= agreement * size:
            best = begin[k], stops[k], agree[k]
    return best


def _matches(index: DataFrame, items: Items, share: float, agreement: float) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(items)

    def search(batches):
        items = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                doc, start, term, n, step = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in range(5))
                at, place = in_shard(items, term.view(np.uint64), n, step)
                row = np.searchsorted(start, at, "right") - 1
                term_of, term = np.divmod(np.unique(row * np.int64(len(items.terms)) + place), len(items.terms))
                # whole texts together, as many as have about POSTS places
                ends = np.flatnonzero(np.r_[term_of[1:] != term_of[:-1], True]) + 1 if len(term) else np.empty(0, np.int64)
                part = np.cumsum(items.first[term + 1] - items.first[term])[ends - 1] // POSTS
                edges = np.r_[0, ends[np.flatnonzero(np.r_[part[1:] != part[:-1], True])]] if len(ends) else [0]
                out = []
                for s, e in zip(edges[:-1], edges[1:]):
                    for pair in could_hold(term_of[s:e], term[s:e], items, share, agreement).tolist():
                        d, item = divmod(pair, len(items.ids))
                        length = items.length(item)
                        own = slice(*np.searchsorted(row, [d, d + 1]))
                        b, t, agree = passage(*items.met(item, at[own], place[own]), length, least=share * length, agreement=agreement)
                        if t > b:
                            out.append((doc[d], items.ids[item], (t - b) / length, agree / (t - b)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int64(), pa.string(), pa.float64(), pa.float64()))], names=["doc_id", "item_id", "share", "agreement"])

    return index.mapInArrow(search, "doc_id long, item_id string, share double, agreement double")


def leaked_items(docs: DataFrame, items: DataFrame, share: float = 0.46, agreement: float = 0.9) -> DataFrame:
    """(doc_id, item_id, share, agreement) of documents (doc_id, text) holding at least this share of an item (item_id, text) as one passage.

    Spacing, line breaks, case, width and punctuation do not count, nor do insertions of up to 60 characters and scattered
    damaged ones, as long as the given part of the passage agrees. share is measured in bare characters; its default is
    half less what damage at the ends may hide.
    Null or empty texts match nothing, nor do items of fewer than LEAST bare characters. Repeated documents and items give
    their match once; null ids and further columns are left out. The documents are scanned once, whatever the number of
    items; blocks of BLOCK_CHARS characters of items are searched in the index. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text <> ''")
    rows = items.select("item_id", "text").filter("item_id is not null and text <> ''").distinct().orderBy("item_id", "text")
    wanted, blocks = np.zeros(TABLE, bool), 0
    for block in _blocks(rows):
        mark(wanted, block.terms)
        blocks += 1
    found = docs.sparkSession.createDataFrame([], "doc_id long, item_id string, share double, agreement double")
    if wanted.any():
        index = postings(docs, wanted)
        for block in _blocks(rows) if blocks > 1 else [block]:
            if len(block.terms):
                found = found.unionByName(_matches(index, block, share, agreement))
    return found.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"), F.max("agreement").alias("agreement"))


def _blocks(rows: DataFrame):
    """The items in blocks; one block at a time is held."""
    ids, texts, size = [], [], 0
    for r in rows.toLocalIterator():
        if len(bare(pa.array([r["text"]], pa.string()))[0]) < LEAST:
            continue
        ids.append(r["item_id"]), texts.append(r["text"])
        size += len(r["text"])
        if size >= BLOCK_CHARS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)
