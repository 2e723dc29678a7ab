"""Language identification with spans.

Method: letters are the code points of Unicode's categories L*; those of a word belong to one script (ranges; other letters form the
script ``other``), combining marks inside a script's range go with its words, and only languages that were seen in a word's script are
candidates for it. A word's score per language is the log-likelihood of its letter trigrams (with a blank at either end),
counted over all labelled training texts in hashed cells. Viterbi over the word scores, with a fixed penalty for each
switch, labels the spans of a text; the text's language is the one with most letters in its spans.

Training counts are additive tables (language, cell) combined map-side, so they cover every training text and their
size depends on the number of languages and cells only; the model is a few arrays, broadcast to the scan.

Constant paths are decided without the sequential recursion: if no other language gains more than the penalty on any stretch of
the text, the single-language path is optimal. Only other texts run Viterbi word by word.

Defined results: null text and text without letters are ``und`` with score 0 and no spans, as is everything if there is nothing
to learn from; null languages are not learned; ties go to the first language in order; repeated rows are judged alike;
an empty table gives an empty result; other columns are never read; a carried column named like a result is replaced.
Counts reach the driver as one pair of arrays per language (at most ``CELLS`` and a few numbers each), for at most
``MOST_LANGUAGES`` languages; more raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.llm import textwords as tw

CELLS = 1 << 15
SWITCH = 25.0
# A language is a candidate in a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
PIECE_BYTES = 1 << 19
MOST_LANGUAGES = 1000

# First code points of script ranges and what they hold (blocks of the Unicode standard).
SCRIPTS = (
    (0x0041, "latin"), (0x005B, ""), (0x0061, "latin"), (0x007B, ""), (0x00AA, "latin"), (0x00AB, ""), (0x00B5, "latin"),
    (0x00B6, ""), (0x00BA, "latin"), (0x00BB, ""), (0x00C0, "latin"), (0x00D7, ""), (0x00D8, "latin"), (0x00F7, ""),
    (0x00F8, "latin"), (0x02B0, ""), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x07C0, ""), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1400, "canadian"), (0x1680, ""),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""),
    (0x2C60, "latin"), (0x2C80, ""), (0x3040, "kana"), (0x3100, "bopomofo"), (0x3130, "hangul"), (0x3190, ""),
    (0x3400, "han"), (0x4DC0, ""), (0x4E00, "han"), (0xA000, "yi"), (0xA4D0, ""), (0xAC00, "hangul"), (0xD7B0, ""),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB07, ""), (0xFB50, "arabic"), (0xFE00, ""), (0xFE70, "arabic"), (0xFF00, ""),
    (0x20000, "han"), (0x30000, ""),
)
NAMES = sorted({s for _, s in SCRIPTS if s} | {"other"})


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: script number, -1 outside words; whether it is a letter."""
    import unicodedata
    kind = np.array([unicodedata.category(chr(i))[0] for i in range(0x110000)])
    starts = np.array([a for a, _ in SCRIPTS], np.uint32)
    number = np.array([-1] + [NAMES.index(s) if s else -1 for _, s in SCRIPTS], np.int16)
    script = number[np.searchsorted(starts, np.arange(0x110000, dtype=np.uint32), "right")]
    letter = kind == "L"
    script[letter & (script < 0)] = NAMES.index("other")
    script[~letter & (kind != "M")] = -1
    return script, letter


def _script_of(code: np.ndarray) -> np.ndarray:
    """Script number of each code point, -1 for none."""
    return _tables()[0][code]


def _letters(texts, at: int, end: int):
    """Of rows at..end: script and lower-cased code of every letter, word number of every letter, text of every word."""
    strings = [t or "" for t in texts.slice(at, end - at).to_pylist()]
    size = np.array([len(t) for t in strings])
    code = np.frombuffer("".join(strings).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(code) != size.sum():  # lower() changed a length
        strings = [t.lower() for t in strings]
        size = np.array([len(t) for t in strings])
        code = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    script = _script_of(code)
    text = np.repeat(np.arange(end - at), size)
    pos = np.flatnonzero(script >= 0)
    new = np.ones(len(pos), bool)
    new[1:] = (pos[1:] != pos[:-1] + 1) | (text[pos[1:]] != text[pos[:-1]]) | (script[pos[1:]] != script[pos[:-1]])
    if len(pos):  # marks alone are no word
        heads = np.flatnonzero(new)
        real = np.add.reduceat(_tables()[1][code[pos]].astype(np.int64), heads) > 0
        if not real.all():
            pos, new = (x[np.repeat(real, np.diff(np.append(heads, len(new))))] for x in (pos, new))
    word = np.cumsum(new) - 1
    return code[pos], script[pos], word, new, text[pos[new]]


def _cells(code: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Hashed trigram cells centred at every letter; a word's ends count as blanks."""
    c = code.astype(np.uint64)
    left, right = np.empty_like(c), np.empty_like(c)
    left[1:], right[:-1] = c[:-1], c[1:]
    if len(c):
        left[0] = right[-1] = 32
    left[new] = 32
    last = np.roll(new, -1)
    if len(last):
        last[-1] = True
    right[last] = 32
    return (tw.mix64(left << np.uint64(42) | c << np.uint64(21) | right) % np.uint64(CELLS)).astype(np.int64)


def _pieces(texts) -> Iterator[tuple[int, int]]:
    for at, end, _, _ in tw.pieces(texts, PIECE_BYTES):
        yield at, end


def _count(batches: Iterator) -> Iterator:
    """lang, text -> lang, cell, n; cells from CELLS on count letters by script."""
    import pyarrow as pa
    total: dict[str, np.ndarray] = {}
    for b in batches:
        langs = np.array(b.column(0).to_pylist(), object)
        for at, end in _pieces(b.column(1)):
            code, script, word, new, text = _letters(b.column(1), at, end)
            cell = _cells(code, new)
            owner = langs[at:end][text][word] if len(word) else np.zeros(0, object)
            for lang in set(langs[at:end]):
                mine = owner == lang
                counts = np.bincount(cell[mine], minlength=CELLS + len(NAMES))
                counts[CELLS:] += np.bincount(script[mine], minlength=len(NAMES))
                total[lang] = total.get(lang, 0) + counts
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at])],
                                         names=["lang", "cell", "n"])


class Model:
    """languages (sorted), score (one row per cell, one column per language) and candidates (scripts x languages), from (language,
    cells, counts), where cells and counts may be numbers or arrays."""

    def __init__(self, rows: list[tuple]):
        self.languages = sorted({r[0] for r in rows})
        counts = np.zeros((CELLS + len(NAMES), len(self.languages)))
        for lang, cell, n in rows:
            counts[cell, self.languages.index(lang)] = n
        grams, scripts = counts[:CELLS], counts[CELLS:]
        self.score = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * CELLS)) if self.languages else grams
        self.candidates = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)


def train(docs: DataFrame) -> Model:
    """Model of all rows of ``docs`` (text, lang) with a language."""
    counts = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
              .mapInArrow(_count, "lang string, cell bigint, n bigint")
              .groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("c")).select("lang", "c.cell", "c.n")
    rows = packed.limit(MOST_LANGUAGES + 1).toArrow().combine_chunks()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return Model([(lang, np.asarray(c.values), np.asarray(n.values)) for lang, c, n in
                  zip(rows["lang"].to_pylist(), rows["cell"], rows["n"])])


def _viterbi(score: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word of one text."""
    n, k = score.shape
    back = np.zeros((n, k), np.int64)
    best = score[0].copy()
    own = np.arange(k)
    for i in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - penalty
        back[i] = np.where(stay, own, top)
        best = np.where(stay, best, best[top] - penalty) + score[i]
    path = np.empty(n, np.int64)
    path[-1] = best.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def label(model: Model, texts, at: int, end: int, penalty: float = SWITCH):
    """(text of every word, letters of every word, label of every word) of rows at..end."""
    code, script, word, new, text = _letters(texts, at, end)
    n = len(text)
    if n == 0 or not model.languages:
        return text[:0], np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(new)
    gram = model.score[_cells(code, new)]
    score = np.add.reduceat(gram, heads, axis=0)
    size = np.diff(np.append(heads, len(code)))
    fits = model.candidates[script[heads]]
    some = fits.any(1)
    # not a candidate: as bad as the worst candidate, less the penalty; a script nobody has says nothing
    worst = np.where(fits, score, np.inf).min(1)
    score = np.where(fits, score, np.where(some, worst - penalty, 0.0)[:, None])
    score[~some] = 0.0
    bounds = np.searchsorted(text, np.arange(end - at + 1))
    full = np.flatnonzero(np.diff(bounds) > 0)
    total = np.add.reduceat(score, bounds[full], axis=0)
    lead = np.zeros(end - at, np.int64)
    lead[full] = total.argmax(1)
    path = lead[text]
    # largest gain of another language on any stretch; texts are kept apart by a falling offset
    mixed = np.zeros(end - at, bool)
    for k in range(len(model.languages)):
        gain = score[:, k] - score[np.arange(n), path]
        run = np.cumsum(gain)
        fall = -text * (np.abs(gain).sum() * 2 + 1)
        start = np.concatenate([[0], run[:-1]]) + fall
        top = run + fall - np.minimum.accumulate(start)
        mixed |= np.bincount(text, top > penalty, end - at) > 0
    for t in np.flatnonzero(mixed):
        a, b = bounds[t], bounds[t + 1]
        path[a:b] = _viterbi(score[a:b], penalty)
    return text, size, path


def identify(docs: DataFrame, model: Model, keep: list[str], penalty: float = SWITCH) -> DataFrame:
    """``keep`` columns, lang_pred, score (share of the letters in spans of lang_pred) and spans: (first,
    last, lang) with words counted from 0; words are runs of letters of one script."""
    keep = [c for c in keep if c not in ("lang_pred", "score", "spans")]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.score, model.candidates))
    fields = [docs.schema[c] for c in keep]

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = Model([])
        m.languages, m.score, m.candidates = shared.value
        names = np.array([*m.languages, "und"], object)
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string())]))
        for b in batches:
            texts = b.column(len(keep))
            for at, end in _pieces(texts):
                text, size, path = label(m, texts, at, end, penalty)
                k, rows = len(m.languages), end - at
                letters = np.bincount(text * (k + 1) + path, size, rows * (k + 1)).reshape(rows, k + 1)
                whole = letters.sum(1)
                best = np.where(whole > 0, letters.argmax(1), k)
                part = np.where(whole > 0, letters[np.arange(rows), best] / np.maximum(whole, 1), 0.0)
                head = np.ones(len(text), bool)
                head[1:] = (text[1:] != text[:-1]) | (path[1:] != path[:-1])
                h = np.flatnonzero(head)
                first_of = np.searchsorted(text, np.arange(rows + 1))
                stop = np.append(h[1:], len(text)) - 1 if len(h) else h
                values = pa.StructArray.from_arrays(
                    [pa.array(h - first_of[text[h]]), pa.array(stop - first_of[text[h]]), pa.array(names[path[h]], pa.string())],
                    names=["first", "last", "lang"])
                offsets = pa.array(np.searchsorted(text[h], np.arange(rows + 1)).astype(np.int32))
                spans = pa.ListArray.from_arrays(offsets, values).cast(span)
                cols = [b.column(i).slice(at, rows) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(names[best], pa.string()), pa.array(part), spans],
                                                 names=[*keep, "lang_pred", "score", "spans"])

    from pyspark.sql import types as T
    out = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                        T.StructField("spans", T.ArrayType(T.StructType([
                            T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                            T.StructField("lang", T.StringType())])))])
    return docs.select(*keep, "text").mapInArrow(scan, out)
