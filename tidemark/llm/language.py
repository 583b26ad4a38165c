"""Operator 1: languages of texts and of their spans.

``train`` counts letter n-grams (2 to 4 letters with word borders) per language, hashed into counters, and the
scripts that a language is written in. It learns every label, from a bounded sample: at most ``SAMPLE_ROWS`` labelled rows per
language, those of least id hash. There are ``BUCKETS`` counters per language, or as many fewer as keep the model of all
languages within ``MODEL_BYTES``, so it may be broadcast.

``label`` scores every word of every whole text. A word is a run of letters of one script with their marks. Its script, by code
point ranges, narrows the languages to those written in it. Viterbi over the word scores, with a penalty for a switch between neighbours, labels spans of
mixed-language texts. The prediction is the language whose spans hold most letters; its score is their share of all letters.

Defined cases: a null text or one without a letter is ``und`` with score 0 and no spans, so is every text if nothing is labelled.
Ties go to the language first in the alphabet. Rows with a null label are not learned from. Repeated rows get equal
predictions, an empty table gives an empty result, and the added column is one struct whose name the caller picks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import keep, remainder, table
from tidemark.llm.hashing import mix

UNKNOWN = "und"
SAMPLE_ROWS = 1500
#: Shares of a language whose rows are picked from apart first, and then again: no task sorts all rows of a language.
SALTS = (64, 8)
BUCKETS, MODEL_BYTES = 1 << 17, 128 << 20
ORDERS = (2, 3, 4)
#: Log-probability lost by a change of language between two words, and added count of every n-gram.
SWITCH, SMOOTH = 6.0, 0.1
#: A language is written in a script that has this share of its training letters.
SCRIPT_SHARE = 0.02
CHUNK_CHARS = 1 << 20
#: First code points of ranges and their scripts: fixed values of the Unicode blocks.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2E80, "han"), (0x3040, "kana"),
    (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
)
SCRIPT_NAMES = tuple(sorted({name for _, name in SCRIPTS}))


LETTER, MARK = 1, 2


@lru_cache(maxsize=1)
def letter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point whether it is a letter or a mark, its lower case where that is one code point, and its script."""
    kind, lower = np.zeros(0x110000, dtype=np.uint8), np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            kind[code] = LETTER
            small = c.lower()
            if len(small) == 1:
                lower[code] = ord(small)
        elif code > 0x2FF and unicodedata.category(c)[0] == "M":
            kind[code] = MARK
    names = {name: n for n, name in enumerate(SCRIPT_NAMES)}
    ranges = np.array([names[name] for _, name in SCRIPTS], dtype=np.uint8)
    script = ranges[np.searchsorted([first for first, _ in SCRIPTS], np.arange(0x110000), side="right") - 1]
    return kind, lower, script


class Words:
    """The words of some texts and the n-grams of each: runs of letters of one script, with the marks among them."""

    def __init__(self, texts: list[str]):
        kinds, lower, script = letter_tables()
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind, written = kinds[codes], script[codes]
        both = (kind[1:] == LETTER) & (kind[:-1] == LETTER)
        cuts = np.flatnonzero(both & (written[1:] != written[:-1])) + 1
        place = np.arange(len(codes))
        if len(cuts):  # a border between letters of two scripts
            codes, kind, place = np.insert(codes, cuts, 0), np.insert(kind, cuts, 0), np.insert(place, cuts, cuts)
        inside = kind > 0
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        letters = np.concatenate([[0], np.cumsum(kind == LETTER)])
        some = letters[end] > letters[start]  # marks alone are no word
        self.own_start, self.own_end = start[some], end[some]
        self.start, self.end = place[self.own_start], place[self.own_end - 1] + 1
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(ends, self.start, side="right")
        self.begin = np.concatenate([[0], ends[:-1]])
        self.codes = np.where(inside, lower[codes], 0).astype(np.uint64)
        self.script = script[codes[self.own_start]]

    def scripts(self) -> np.ndarray:
        """The script of each word, by its first letter."""
        return self.script

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per order the word of each n-gram and its bucket; a word has a border (0) on both sides."""
        padded = np.concatenate([[0], self.codes]).astype(np.uint64)
        sizes = self.own_end - self.own_start + 2  # with borders; a border in `padded` lies at place start, the word from start + 1
        for n in ORDERS:
            count = np.maximum(sizes - n + 1, 0)
            word = np.repeat(np.arange(len(count)), count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.own_start[word]
            value = np.full(len(place), n, dtype=np.uint64)
            for k in range(n):
                value = value * np.uint64(0x100000001B3) + padded[place + k]
            yield word, (mix(value) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _chunks(texts: pa.Array, languages: int = 1) -> Iterator[tuple[int, list[str]]]:
    """About ``CHUNK_CHARS`` at a time, fewer where words are scored in very many languages."""
    most = CHUNK_CHARS * 256 // max(languages, 256)
    first, out, size = 0, [], 0
    for n, value in enumerate(texts):
        out.append(value.as_py() or "")
        size += len(out[-1])
        if size >= most:
            yield first, out
            first, out, size = n + 1, [], 0
    if out:
        yield first, out


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, letters: np.ndarray):
        """``counts``: languages x a power of two of buckets; ``letters``: languages x scripts."""
        self.languages, self.buckets = languages, counts.shape[1]
        total = counts.sum(axis=1, keepdims=True)
        self.log = np.ascontiguousarray(np.log((counts + SMOOTH) / (total + SMOOTH * self.buckets)).T.astype(np.float32))
        shares = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        written = shares >= SCRIPT_SHARE
        known = written.any(axis=0)
        self.excluded = np.where(written | ~known, 0, -1e6).T.astype(np.float32)  # a script that nobody writes excludes nobody

    def scores(self, words: Words) -> np.ndarray:
        """Log-probability of each word in each language."""
        out = self.excluded[words.scripts()].copy()
        for word, bucket in words.grams():
            if len(word):
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                out[word[first]] += np.add.reduceat(self.log[bucket & (self.buckets - 1)], first, axis=0)
        return out

    def path(self, scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The language of each word: Viterbi over all texts side by side, the longest first."""
        order = np.argsort(-counts, kind="stable")
        first = (np.cumsum(counts) - counts)[order]
        sizes = counts[order]
        steps = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")  # texts with more than t words
        came = np.zeros(scores.shape, dtype=np.uint8 if len(self.languages) <= 256 else np.uint16)
        now = scores[first[: alive[0]]] if steps else scores[:0]
        own = np.arange(len(self.languages))
        last = np.zeros((len(sizes), len(self.languages)), dtype=scores.dtype)
        for t in range(steps):
            n = alive[t]
            if t:
                last[n : len(now)] = now[n:]
                now = now[:n]
                top = now.argmax(axis=1)
                best = now[np.arange(n), top][:, None] - np.float32(SWITCH)
                switch = best > now
                at = first[:n] + t
                came[at] = np.where(switch, top[:, None], own)
                now = np.where(switch, best, now) + scores[at]
        last[: len(now)] = now
        label = np.zeros(len(scores), dtype=np.int64)
        state = last.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            n = alive[t]
            at = first[:n] + t
            label[at] = state[:n]
            state[:n] = came[at, state[:n]] if t else state[:n]
        return label

    def label(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        words = Words(texts)
        counts = np.bincount(words.text, minlength=len(texts))
        if not self.languages or not len(words.text):
            return [(UNKNOWN, 0.0, [])] * len(texts)
        label = self.path(self.scores(words), counts)
        sizes = words.end - words.start
        letters = np.zeros((len(texts), len(self.languages)))
        np.add.at(letters, (words.text, label), sizes)
        total, best = letters.sum(axis=1), letters.argmax(axis=1)
        new = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1])]))
        stop = np.concatenate([new[1:], [len(label)]]) - 1
        spans: list[list[dict]] = [[] for _ in texts]
        for a, b in zip(new.tolist(), stop.tolist()):
            text = int(words.text[a])
            begin = int(words.begin[text])
            spans[text].append({"start": int(words.start[a]) - begin, "end": int(words.end[b]) - begin, "lang": self.languages[label[a]]})
        return [
            (self.languages[b], float(letters[n, b] / total[n]), spans[n]) if total[n] else (UNKNOWN, 0.0, []) for n, b in enumerate(best)
        ]


def buckets_for(languages: int) -> int:
    """Counters per language."""
    return min(BUCKETS, 1 << max(MODEL_BYTES // (4 * max(languages, 1)), 1).bit_length() - 1)


def train(docs: DataFrame, learn: Column, lang: str = "lang", text: str = "text", key: str = "doc_id") -> Model:
    """The model of the rows that ``learn`` selects. Ids only pick the sample."""
    rows = docs.filter(learn & docs[lang].isNotNull()).select(docs[lang].cast("string").alias("lang"), docs[text].cast("string").alias("text"), F.xxhash64(docs[key]).alias("pick"))
    chosen = rows.select("lang", "pick")
    for salts in SALTS:
        share = F.pmod("pick", F.lit(salts))
        place = F.row_number().over(Window.partitionBy("lang", share).orderBy("pick"))
        chosen = chosen.withColumn("n", place).filter(F.col("n") <= SAMPLE_ROWS)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))
    chosen = chosen.withColumn("n", place).filter(F.col("n") <= SAMPLE_ROWS)
    # rows, not ids, are bounded: a hash that several rows share at the edge may add these
    edge = chosen.groupBy("lang").agg(F.max("pick").alias("edge"))
    sample = rows.join(F.broadcast(edge), "lang").filter("pick <= edge").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, texts in _chunks(batch.column(1)):
                words = Words(texts)
                own = langs[first : first + len(texts)]
                names = sorted(set(own))
                index = np.array([names.index(x) for x in own])
                keys = [index[words.text] * 2 * BUCKETS + BUCKETS + words.scripts()]
                weights = [words.end - words.start]
                for word, bucket in words.grams():
                    keys.append(index[words.text[word]] * 2 * BUCKETS + bucket)
                    weights.append(np.ones(len(word), dtype=np.int64))
                key_, at = np.unique(np.concatenate(keys), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate(weights), minlength=len(key_)).astype(np.int64)
                columns = [[names[x] for x in key_ // (2 * BUCKETS)], key_ % (2 * BUCKETS), n]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["lang", "bucket", "n"])

    counted = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    by_lang = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    by_lang = keep(by_lang)
    size = buckets_for(by_lang.count())
    languages, counts, letters = [], [], []
    for row in by_lang.orderBy("lang").toLocalIterator():  # one language at a time, folded to its share of MODEL_BYTES
        bucket, n = np.array([(c["bucket"], c["n"]) for c in row["counts"]], dtype=np.int64).reshape(-1, 2).T
        gram = bucket < BUCKETS
        languages.append(row["lang"])
        counts.append(np.bincount(bucket[gram] & (size - 1), weights=n[gram], minlength=size).astype(np.float32))
        letters.append(np.bincount(bucket[~gram] - BUCKETS, weights=n[~gram], minlength=len(SCRIPT_NAMES)))
    if not languages:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((0, len(SCRIPT_NAMES))))
    return Model(languages, np.array(counts), np.array(letters))


SPANS = "array<struct<start: long, end: long, lang: string>>"


def label(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into``: lang, score and spans (start, end, lang; code points, end excluded)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))])

    @F.arrow_udf(f"lang string, score double, spans {SPANS}")
    def labels(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [r for _, texts in _chunks(batch, len(shared.value.languages)) for r in shared.value.label(texts)]
            yield pa.array([{"lang": lang, "score": score, "spans": spans} for lang, score, spans in rows], kind)

    return docs.withColumn(into, labels(docs[text].cast("string")))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = label(docs.drop("lang"), train(docs, ~held_out))
    x = F.col("language")
    return found.select(
        "doc_id", held_out.alias("held_out"), x["lang"].alias("lang_pred"), x["score"].alias("score"), F.size(x["spans"]).alias("n_spans")
    )
