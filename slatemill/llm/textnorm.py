"""One consistent form for text that looks the same but differs in its characters.

Compatibility normalization (width, kinds of blank, accent composition, compatibility ideographs) and the deletion of
ignorable characters are one translation table. Letters that look alike across scripts then form a lattice for each token;
Viterbi picks the path under character bigram scores that reward staying in one script. What a letter may stand for depends
on its shape only, never on which look-alike was written, so texts that look the same get the same form. Some letters have a
shape that is drawn for two others (an upright bar is an I as well as an l): for these the search decides which is meant.
"""

import math
import re
import unicodedata
from collections import Counter
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatemill.plans.cut import cut

#: Letters of the same shape (Latin, Cyrillic, Greek, Coptic, Armenian, Cherokee, Lisu), the Latin one first. Fixed values.
SHAPES = (
    "aа", "cсϲⲥ", "dԁ", "eе", "gɡց", "hһհ", "iі", "jјϳ", "l", "nո", "oоοⲟօ", "pрⲣ", "qԛզ", "sѕ", "uս", "vν", "wԝ", "xхⲭ", "yу",
    "AАΑⲀᎪꓮ", "BВΒⲂᏴꓐ", "CСϹⲤᏟꓚ", "DᎠꓓ", "EЕΕⲈᎬꓰ", "FꓝϜ", "GᏀꓖ", "HНΗⲎᎻꓧ", "IІΙⲒ", "JЈᎫꓙ", "KКΚⲔᏦꓗ", "LԼᏞꓡ", "MМΜⲘᎷꓟ", "NΝⲚꓠ", "OОΟⲞՕꓳ", "PРΡⲢᏢꓑ",
    "RᏒꓣ", "SЅՏᏚꓢ", "TТΤⲦᎢꓔ", "UՍꓴ", "VᏙꓦ", "WԜᏔꓪ", "XХΧⲬꓫ", "YҮΥⲨꓬ", "ZΖⲌᏃꓜ",
)
#: Letters whose shape is drawn for several of the shapes above, the likelier one first. Fixed values.
SHARED = {"ӏ": "lI", "Ӏ": "Il", "ǀ": "lI", "ꓲ": "Il", "Ꮖ": "Il"}
#: Radicals without a compatibility decomposition, as pairs of the radical and the ideograph of that shape. Fixed values.
RADICALS = "⺁厂 ⺇几 ⺓幺 ⺟母 ⺠民 ⺩王 ⺫罒 ⺬示 ⺮竹 ⺶羊 ⺼月 ⺽臼 ⻁虎 ⻄西 ⻅见 ⻆角 ⻉贝 ⻋车 ⻑長 ⻓长 ⻔门 ⻗雨 ⻘青 ⻙韦 ⻚页 ⻛风 ⻜飞 ⻝食 ⻢马 ⻣骨 ⻤鬼 ⻥鱼 ⻦鸟 ⻧卤 ⻨麦 ⻩黄 ⻪黾 ⻬齐 ⻮齿 ⻰龙 ⻳龟"
#: Signs of the same shape. Fixed values.
SIGNS = {"∶": ":", "ː": ":", "‐": "-", "‑": "-", "−": "-", "∕": "/", "⁄": "/", "∣": "|", "’": "'", "‘": "'", "ʼ": "'", "․": ".", "•": "·", "‧": "·", "・": "·"}
#: Kinds of decomposition whose result looks different.
VISIBLE = ("<super>", "<sub>", "<circle>", "<fraction>", "<vertical>", "<square>")
#: Runs of alphabetic letters, ideographs and kana aside; combining marks belong to the run.
TOKEN = re.compile(r"[^\W\d_぀-ヿ㐀-鿿가-힣\uf900-\ufaffｦ-ﾟ][^\W\d_぀-ヿ㐀-鿿가-힣\uf900-\ufaffｦ-ﾟ]*")
#: The tables' letters are at most this many code points, which bounds the bigram model.
MAX_BIGRAMS = 400_000


@cache
def _alternatives() -> dict[str, tuple[tuple[str, float], ...]]:
    """What a letter may stand for, with the cost of the shape."""
    of = {shape[0]: shape for shape in SHAPES}
    out = {c: tuple((x, 0.0) for x in shape) for shape in SHAPES for c in shape}
    return out | {c: tuple((x, cost) for cost, k in ((0.0, kinds[0]), (Lattice.OTHER, kinds[1])) for x in of[k]) for c, kinds in SHARED.items()}


@cache
def table(shared: bool = True) -> dict[int, str | None]:
    """Code point to its form, None to delete; look-alike letters go to the first of their shape, those of several shapes only if shared."""
    first = {c: shape[0] for shape in SHAPES for c in shape[1:]} | {c: kinds[0] if shared else c for c, kinds in SHARED.items()} | SIGNS | {p[0]: p[1] for p in RADICALS.split()}
    out: dict[int, str | None] = {}
    for code in [*range(0x80, 0x10000), *range(0x1D400, 0x1D800), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)]:
        if 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xE000 or 0xE000 <= code < 0xF900:
            continue
        ch = chr(code)
        kind = unicodedata.category(ch)
        if kind == "Cf" or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or code in (0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0):
            out[code] = None
            continue
        if kind == "Zs":
            out[code] = " "
            continue
        parts = unicodedata.decomposition(ch)
        if ch in first:  # before normalization, which takes some of these for other letters
            if first[ch] != ch:
                out[code] = first[ch]
            continue
        new = ch if parts.startswith(VISIBLE) else unicodedata.normalize("NFKC", ch)
        new = unicodedata.normalize("NFC", "".join(first.get(c, c) for c in unicodedata.normalize("NFD", new))) if parts else new
        if new != ch:
            out[code] = new
    return out | {9: " ", 11: " ", 12: " ", 13: None, 0x85: "\n", 0x2028: "\n", 0x2029: "\n"}


def skeleton(text: str, shared: bool = True) -> str:
    """The text by shape alone, letters of several shapes by their likelier one (or left, if not shared)."""
    return text if text.isascii() and "\t" not in text and "\r" not in text else unicodedata.normalize("NFC", text.translate(table(shared)))


def script(ch: str) -> str:
    """Latin, Cyrillic, Greek, Armenian, Cherokee, Coptic, Lisu or another, by code point."""
    code = ord(ch)
    if code < 0x250 or 0x1E00 <= code < 0x1F00:
        return "L"
    return next((s for s, a, b in (("C", 0x400, 0x530), ("G", 0x370, 0x400), ("G", 0x1F00, 0x2000), ("A", 0x530, 0x590), ("K", 0x13A0, 0x1400), ("P", 0x2C80, 0x2D00), ("S", 0xA4D0, 0xA500)) if a <= code < b), "X")


def bigrams(texts) -> Counter:
    """Counts of character bigrams (^ and $ at the ends) in the tokens of one script; tokens mixing scripts teach nothing."""
    words: Counter = Counter()
    for text in texts:
        if text:
            words.update(TOKEN.findall(text))
    out: Counter = Counter()
    for word, n in words.items():
        word = unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFKC", word) if unicodedata.category(c) != "Cf"))
        if word and len({script(c) for c in word}) == 1:
            for pair in zip("^" + word, word + "$"):
                out["".join(pair)] += n
    return out


class Lattice:
    """Viterbi over the look-alikes of a token; counts: bigram counts. Results are kept for repeated tokens."""

    #: Log costs of a change of script inside a token, and of the less likely one of two shapes.
    MIX, OTHER = 12.0, 3.0

    def __init__(self, counts: dict[str, int]):
        self.counts, self.kept = counts, {}
        self.starts: Counter = Counter()
        for pair, n in counts.items():
            self.starts[pair[0]] += n

    def score(self, a: str, b: str) -> float:
        mixed = a != "^" and b != "$" and script(a) != script(b)
        return math.log((self.counts.get(a + b, 0) + 0.1) / (self.starts.get(a, 0) + 60)) - self.MIX * mixed

    def word(self, word: str) -> str:
        found = self.kept.get(word)
        if found is None:
            paths = {"^": (0.0, "")}
            for ch in word:
                options = _alternatives().get(ch) or ((ch, 0.0),)
                # a tie goes to the path that comes first, which begins with Latin letters
                paths = {c: max(((s + self.score(a, c) - cost, p + c) for a, (s, p) in paths.items()), key=lambda x: x[0]) for c, cost in options}
            found = max(((s + self.score(a, "$"), p) for a, (s, p) in paths.items()), key=lambda x: x[0])[1]
            if len(self.kept) > 200_000:
                self.kept.clear()
            self.kept[word] = found
        return found

    def text(self, text: str) -> str:
        return TOKEN.sub(lambda m: self.word(m[0]), skeleton(text, False))


def count_bigrams(df: DataFrame, column: str) -> dict[str, int]:
    """Bigram counts over all rows. Their number is bounded by the alphabets' square, checked against MAX_BIGRAMS."""

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            total.update(bigrams(batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["pair", "n"])

    rows = df.select(column).mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(MAX_BIGRAMS + 1).collect()
    if len(rows) > MAX_BIGRAMS:
        raise ValueError(f"more than {MAX_BIGRAMS} different letter pairs: not alphabetic text")
    return {r["pair"]: r["n"] for r in rows}


def canonical(df: DataFrame, column: str, counts: dict[str, int], to: str = "canonical", drop_text: bool = False) -> DataFrame:
    """df with the canonical form of a text column (null stays null, empty stays empty), in Arrow batches.

    drop_text: give the 128-bit digests ``{to}_key`` and ``raw_key`` instead of the form and the text, for joining.
    Columns of df that have the name of a new one are replaced. Repeated rows stay repeated.
    """
    import xxhash

    shared = df.sparkSession.sparkContext.broadcast(counts)
    new = {column, f"{to}_key", "raw_key"} if drop_text else {to}
    rest = [c for c in df.columns if c not in new]

    def form(batches):
        lattice = Lattice(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
            forms = [None if t is None else lattice.text(t) for t in texts]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            if drop_text:
                digest = lambda xs: pa.array([None if x is None else xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in xs], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, digest(forms), digest(texts)], names=[*rest, f"{to}_key", "raw_key"])
            else:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(forms, pa.string())], names=[*rest, to])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in rest)
    return df.mapInArrow(form, kinds + (f", {to}_key binary, raw_key binary" if drop_text else f", {to} string"))


def _varied(keyed: DataFrame) -> DataFrame:
    """Rows (src, canonical_key, raw_key, id), each once, of the groups that have several spellings; the rest is dropped by a partial aggregation."""
    keyed = keyed.filter("id is not null and canonical_key is not null")
    varied = keyed.groupBy("src", "canonical_key").agg(F.min("raw_key").alias("low"), F.max("raw_key").alias("high")).filter("low <> high").select("src", "canonical_key")
    return keyed.join(varied, ["src", "canonical_key"]).select("src", "canonical_key", "raw_key", "id").distinct()


def look_alike_classes(keyed: DataFrame) -> DataFrame:
    """(src, id, class_id, spelling) of the rows whose text looks like another but differs; keyed: src, id, canonical_key, raw_key.

    Rows of one class_id look the same, those of one spelling are equal. One row for each id and spelling, so a crowd of
    copies stays linear. Null and repeated rows give nothing.
    """
    return _varied(keyed).select("src", "id", F.hex("canonical_key").alias("class_id"), F.hex("raw_key").alias("spelling"))


def look_alikes(keyed: DataFrame, block: int = 1000) -> DataFrame:
    """Pairs (src, id_a, id_b) of rows whose texts look the same but differ; keyed: src, id, canonical_key, raw_key.

    The classes are joined spelling by spelling, so copies of one spelling are never paired with each other. A spelling of
    more than ``block`` ids is cut into blocks, and each two blocks meet in a place of their own, so no task holds a crowd.
    """
    by = ("src", "canonical_key")
    members = cut(_varied(keyed))
    sizes = members.groupBy(*by, "raw_key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    one, two = (sizes.select(*by, F.col("raw_key").alias(f"raw_{x}"), F.col("blocks").alias(f"blocks_{x}")) for x in "ab")
    every = lambda x: F.explode(F.sequence(F.lit(0), F.col(f"blocks_{x}") - 1)).alias(f"block_{x}")
    pairs = one.join(two, [*by]).filter("raw_a < raw_b").select("*", every("a")).select("*", every("b")).drop("blocks_a", "blocks_b")
    placed = members.join(sizes, [*by, "raw_key"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    side = lambda x, name: placed.select(*by, F.col("raw_key").alias(f"raw_{x}"), F.col("own").alias(f"block_{x}"), F.col("id").alias(name))
    places = [*by, "raw_a", "raw_b", "block_a", "block_b"]
    joined = pairs.join(side("a", "one"), [*by, "raw_a", "block_a"]).select(*places, "one").join(pairs.join(side("b", "two"), [*by, "raw_b", "block_b"]).select(*places, "two"), places).filter("one <> two")
    return joined.select("src", F.least("one", "two").alias("id_a"), F.greatest("one", "two").alias("id_b")).distinct()
