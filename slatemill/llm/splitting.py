"""Splitting oversized texts at natural boundaries: range-maximum queries over boundary strengths."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatemill.llm import tokenizer

#: Settings that one pass may serve; bounds what is broadcast.
MAX_SETTINGS = 1000
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, BARE = 6, 5, 4, 3, 2, 1


def _of(chars: str) -> np.ndarray:
    table = np.zeros(0x10000, bool)
    table[[ord(c) for c in chars]] = True
    return table


_ENDS, _CLAUSES, _BLANKS, _CLOSERS = _of("。！？!?…"), _of("，；：、,;:】）)|"), _of(" \t　 "), _of("”’」』）)】\"'")
_ITEM = _of("0123456789ABCDEFGH０１２３４５６７８９")


def strengths(codes: np.ndarray) -> np.ndarray:
    """Strength of a cut before each character, for one or more texts in a row; larger is more natural."""
    c = np.minimum(codes, 0xFFFF)
    before, earlier = np.r_[0, c][: len(c)], np.r_[0, 0, c][: len(c)]
    out = np.full(len(c), BARE, np.int8)
    blank = _BLANKS[c]
    out[(blank & ~_BLANKS[before]) | (~blank & _BLANKS[before] & (c != 10))] = WORD
    out[_CLAUSES[before] & ~blank] = CLAUSE
    full_stop = ((before == 46) & (blank | (c == 10))) | ((before == 0xFF0E) & ~_ITEM[earlier])
    end = _ENDS[before] | full_stop
    out[(end & ~_ENDS[c] & ~_CLOSERS[c]) | (_CLOSERS[before] & _ENDS[earlier] & ~_CLOSERS[c])] = SENTENCE
    out[(before == 10) & (c != 10)] = LINE
    out[(before == 10) & (earlier == 10) & (c != 10)] = PARAGRAPH
    return out


class Strongest:
    """A sparse table over boundary strengths: the strongest place in a range, the rightmost of equals, in constant time."""

    def __init__(self, strength: np.ndarray):
        level = strength.astype(np.int64) << 40 | np.arange(len(strength))
        self.levels = [level]
        step = 1
        while 2 * step <= len(strength):
            level = np.maximum(level[:-step], level[step:])
            self.levels.append(level)
            step *= 2

    def best(self, low: int, high: int) -> int:
        """The place in [low, high]."""
        k = (high - low + 1).bit_length() - 1
        row = self.levels[k]
        return int(max(row[low], row[high - (1 << k) + 1])) & ((1 << 40) - 1)


def split(model: tokenizer.Pieces, text: str, strength: np.ndarray, safe: np.ndarray, upto: np.ndarray, limits: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """For each (limit, overlap) the pieces (begin, end, tokens) of a text.

    strength, safe: of a cut before each character; upto: tokens of the text before each place (one more than characters).
    Tokens of a piece are exact: those between two safe places are the whole text's, and the piece's head up to its first
    safe place is encoded on its own.
    """
    n, total = len(text), int(upto[-1])
    table, out = None, []
    places = np.flatnonzero(safe)
    for limit, overlap in limits:
        if total <= limit:
            out.append([(0, n, total)])
            continue
        if table is None:
            table = Strongest(np.where(safe, strength, 0))
        pieces, begin = [], 0
        while True:
            if begin:
                k = np.searchsorted(places, begin, "right")
                first = int(places[k]) if k < len(places) else n
                extra = model.count(text[begin:first]) - int(upto[first] - upto[begin])
            else:
                extra = 0
            used = int(upto[begin]) - extra
            if total - used <= limit:
                pieces.append((begin, n, total - used))
                break
            high = int(np.searchsorted(upto, used + limit, "right")) - 1
            low = int(np.searchsorted(upto, used + max(limit // 2, min(limit - 1, overlap + 1)), "left"))
            end = table.best(max(low, begin + 1), high) if max(low, begin + 1) <= high else 0
            if not end or not safe[end]:
                # no safe place in the window: shrink from its end until the piece fits
                end = max(high, begin + 1)
                while end > begin + 1 and model.count(text[begin:end]) > limit:
                    end = max(begin + 1, end - max(1, (end - begin) // 50))
                size = model.count(text[begin:end])
            else:
                size = int(upto[end]) - used
            if pieces and end <= pieces[-1][1]:
                begin += 1  # the overlap fills the whole room: repeat less, at last nothing
                continue
            pieces.append((begin, end, size))
            if end >= n:
                break
            back = int(np.searchsorted(upto, upto[end] - overlap, "left")) if overlap else end
            if upto[back] > upto[end] - overlap:
                back -= 1  # a character of several tokens stays whole
            begin = back if begin < back else end
        out.append(pieces)
    return out


def split_documents(docs: DataFrame, settings: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces (doc_id, setting_id, piece_no, begin, end, n_tokens, piece) of the documents (doc_id, text) longer than a setting's limit.

    settings: (setting_id, max_tokens, overlap_tokens). Each piece has at most max_tokens tokens of a public tokenizer, counted
    as if it stood alone, and ends at the strongest boundary (paragraph, line, sentence, clause, word) in the
    second half of the room, the last of equals. The next begins overlap_tokens tokens before that end (a little more where a
    character has several tokens). begin and end are character positions, so the text is text[0:end_1] + text[end_1:end_2] + ...
    Null texts and texts within the limit give no pieces, nor do settings with a null id or limit or a limit below 1; a null or
    negative overlap is none, and one that is not below its limit is an error, as no piece could go on. A single character of
    more tokens than the limit stays whole. Where the overlap would fill a piece's whole room, that piece
    repeats only as much as lets it go on.
    """
    path = path or tokenizer.default_path()
    rows = settings.select("setting_id", "max_tokens", "overlap_tokens").distinct().limit(MAX_SETTINGS + 1).collect()
    if len(rows) > MAX_SETTINGS:
        raise ValueError(f"more than {MAX_SETTINGS} settings")
    wanted = sorted((r["setting_id"], r["max_tokens"], max(0, r["overlap_tokens"] or 0)) for r in rows if r["setting_id"] is not None and (r["max_tokens"] or 0) >= 1)
    if bad := [s for s, m, o in wanted if o >= m]:
        raise ValueError(f"overlap not below the limit: {bad[:5]}")
    limits = [(m, o) for _, m, o in wanted]
    least = min([m for m, _ in limits], default=0)

    def cut_up(batches):
        model = tokenizer.pieces(path)
        names = ["doc_id", "setting_id", "piece_no", "begin", "end", "n_tokens", "piece"]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out, held = [], 0
            for a in range(0, len(ids), 100):
                # a token has a character at least, or is a byte of one, so a short text needs no look
                some = [(i, t) for i, t in zip(ids[a : a + 100], texts[a : a + 100]) if t and 4 * len(t) + 1 > least]
                for (i, text), token in zip(some, model.encode([t for _, t in some])):
                    if len(token) <= least:
                        continue
                    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                    ends = np.cumsum(model.width[np.array(token)])
                    # the blank put before the text is no character of it; bytes that go on a character belong to its place
                    place = np.minimum(np.maximum(ends - 1, 0), len(codes))
                    upto = np.cumsum(np.bincount(place, minlength=len(codes) + 1))
                    upto[0] = 0
                    safe = np.r_[False, model.safe(codes)]
                    for (setting, *_), found in zip(wanted, split(model, text, strengths(codes), safe, upto, limits)):
                        if len(found) > 1:
                            out.extend((i, setting, k, b, e, n, text[b:e]) for k, (b, e, n) in enumerate(found, 1))
                            held += len(text)
                    if held > 1_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    spec = "doc_id long, setting_id string, piece_no int, begin int, end int, n_tokens int, piece string"
    if not wanted:
        return docs.sparkSession.createDataFrame([], spec)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut_up, spec)
