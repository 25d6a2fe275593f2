"""Toxicity of texts after noisy-channel deobfuscation.

An obfuscated word is read as what somebody meant, sent through a channel that swaps
letters for signs, stretches them and puts separators between them. All readings of a
word form a character lattice; Viterbi decoding finds the one that a character trigram
model of the corpus and the channel together make likeliest. A word whose lattice has
one path is its own reading. The restored text is then scored by a logistic model over
the restored words.

The trigram counts cover all texts. Labels are learned from a bounded sample of the
labelled rows (`sample_rows`, the smallest by a hash of doc_id) by Spark's own
logistic regression over the terms that lean towards toxic ones.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from archivekit.llm import text as T
from archivekit.operators.workspace import stage

#: Letters that the character model tells apart; 0 is the border of a word, the last
#: code any other character (fixed values).
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüœ"
CODES = 64
_OTHER = CODES - 1
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}

#: What a sign may stand for (fixed values).
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "<": "c", "#": "h",
}
#: Signs that may stand between the letters of a word.
SEPARATORS = ".-_*~'`^,:;/\\"
#: Costs of the channel, in nats: a sign for a letter, a letter taken for more than two
#: of it, a separator slipped in, and a sign left as it is.
SIGN, STRETCH, SEPARATE, KEEP = 1.0, 0.5, 0.7, 4.0

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: Three or more single characters with a blank or separator between them.
_SPACED = re.compile(rf"(?<![^\s])(?:[^\s](?:[ ]|[{re.escape(SEPARATORS)}])){{2,}}[^\s](?![^\s{re.escape(SEPARATORS)}!?])")
#: A word worth a lattice: a letter beside a sign or separator, or a stretched letter.
_NOISY = re.compile(
    rf"[^\W\d_][{re.escape(''.join(SIGNS))}{re.escape(SEPARATORS)}]+[^\W_]|[{re.escape(''.join(SIGNS))}][^\W\d_]|[^\W\d_][{re.escape(''.join(SIGNS))}]$|(\w)\1\1")
_EDGES = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "«»“”‘’…–—"
#: Longer words are decoded anew each time, so that memory stays bounded.
LONGEST_REMEMBERED = 64
REMEMBERED = 60_000


def trigram_udf():
    """Counts of character trigrams of a batch, as (code, n) pairs on its first row."""

    @F.arrow_udf("array<struct<code: int, n: bigint>>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        T.kept("trigrams", bool)  # lets go of another operator's tables
        table = np.full(1 << 16, _OTHER, np.int32)
        for c, code in _CODE.items():
            table[ord(c)] = code
        table[[0x20, *range(9, 14)]] = 0
        kind = pa.list_(pa.struct([("code", pa.int32()), ("n", pa.int64())]))
        for batch in batches:
            total = np.zeros(CODES**3, np.int64)
            for part in T.slices(batch, 1 << 19):
                joined = "\n\n".join(["", *(t or "" for t in part.to_pylist()), ""]).lower()
                chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
                codes = table[np.minimum(chars, 0xFFFF)]
                total += np.bincount((codes[:-2] * CODES + codes[1:-1]) * CODES + codes[2:], minlength=CODES**3)
            seen = np.flatnonzero(total)
            pairs = pa.StructArray.from_arrays(
                [pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["code", "n"])
            ends = np.zeros(len(batch) + 1, np.int32)
            ends[1:] = len(seen)
            yield pa.ListArray.from_arrays(pa.array(ends), pairs).cast(kind)

    return count


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a character after two others, counted over all texts.

    Trigrams are backed by the shares of the single characters; at most 64 cubed counts
    reach the driver, whatever the corpus.
    """
    counts = docs.select(F.explode(trigram_udf()("text")).alias("p")).groupBy("p.code").agg(F.sum("p.n").alias("n"))
    table = np.zeros(CODES**3)
    for row in counts.collect():
        table[row["code"]] = row["n"]
    table = table.reshape(CODES, CODES, CODES)
    single = table.sum((0, 1)) + 1.0
    backed = table + 4.0 * single / single.sum()
    return np.log(backed / backed.sum(2, keepdims=True)).astype(np.float32)


class Decoder:
    """Viterbi decoding of character lattices under a trigram model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self._read: dict[str, str] = {}

    @staticmethod
    def lattice(word: str) -> list[list[tuple[str, float]]]:
        """For each run of equal characters, its readings and their costs."""
        slots, i, n = [], 0, len(word)
        while i < n:
            c, j = word[i], i
            while j < n and word[j] == c:
                j += 1
            run = j - i
            if c.isalpha():
                if run > 2:
                    slots.append([(c, STRETCH), (c * 2, STRETCH)])
                else:
                    slots.append([(c * run, 0.0)])
            elif c in SIGNS:
                ways = [(c * run, KEEP * run)] + [(s, SIGN + STRETCH * (run > 1)) for s in SIGNS[c]]
                if run > 1:
                    ways += [(s * 2, SIGN * 1.2) for s in SIGNS[c]]
                slots.append(ways)
            elif c == " " or c in SEPARATORS:
                slots.append([("", SEPARATE), (c, KEEP if i and j < n else 0.0)])
            else:
                slots.append([(c * min(run, 3), 0.0)])
            i = j
        return slots

    def decode(self, word: str) -> str:
        """The likeliest reading of one word in lower case."""
        model, other = self.model, _OTHER
        # A reading is its last letters and the reading before it: work is linear in length.
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for ways in self.lattice(word):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, said) in best.items():
                for letters, cost in ways:
                    x, y, total = a, b, score - cost
                    for c in letters:
                        z = _CODE.get(c, 0 if c == " " else other)
                        total += model[x][y][z]
                        x, y = y, z
                    old = after.get((x, y))
                    if old is None or total > old[0]:
                        after[x, y] = total, (said, letters)
            best = after
        said, out = max(((score + model[x][y][0], said) for (x, y), (score, said) in best.items()), key=lambda x: x[0])[1], []
        while said:
            said, letters = said
            out.append(letters)
        return "".join(reversed(out))

    def restored(self, word: str) -> str:
        """`decode` with memory; words without noise are their own reading."""
        if not _NOISY.search(word):
            return word
        if len(word) > LONGEST_REMEMBERED:
            return self.decode(word)
        said = self._read.get(word)
        if said is None:
            if len(self._read) > REMEMBERED:
                self._read.clear()
            said = self._read[word] = self.decode(word)
        return said

    def restore(self, text: str) -> str:
        """The whole text in lower case, with every noisy word and spaced-out word restored."""
        text = _SPACED.sub(lambda m: self._joined(m[0]), text.lower())
        return _TOKEN.sub(lambda m: self.restored(m[0]), text)

    def _joined(self, spaced: str) -> str:
        chars = spaced[::2]
        return self.decode(spaced) if len(set(chars)) > 2 else spaced

    def token_terms(self, token: str) -> tuple[str, ...]:
        """The restored words in one lower-case token, and the first four and five letters of longer ones."""
        said = self.restored(token)
        words = (said,) if said.isalpha() else {w.strip(_EDGES) for w in said.split()}
        return tuple(t for w in words if w for t in (w, *(w[:k] + "*" for k in (4, 5) if len(w) > k)))

    def tokens(self, text: str) -> set[str]:
        """Distinct lower-case tokens of a text, and the words that spaced-out letters spell."""
        text = text.lower()
        out = set(_TOKEN.findall(text))
        for m in _SPACED.finditer(text):
            out.update(self._joined(m[0]).split())
        return out

    def terms(self, text: str) -> set[str]:
        return {term for token in self.tokens(text) for term in self.token_terms(token)}


def _decoder(model) -> Decoder:
    """One decoder for each broadcast model in a worker."""
    return T.kept(hash(model.value.tobytes()), lambda: Decoder(model.value))


def terms_udf(model):
    @F.arrow_udf("array<string>")
    def terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _decoder(model)
        for batch in batches:
            yield pa.array([sorted(decoder.terms(t.as_py() or "")) for t in batch], pa.list_(pa.string()))

    return terms


def restore_udf(model):
    """Text with its noisy words restored."""

    @F.arrow_udf("string")
    def restore(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _decoder(model)
        for batch in batches:
            yield pa.array([decoder.restore(t.as_py()) if t.is_valid else None for t in batch], pa.string())

    return restore


def score_udf(model, weights):
    """Probability of label 1 under the logistic model over a text's terms."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder, (base, weight) = _decoder(model), weights.value
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            out = []
            for t in batch:
                hits: set[str] = set()
                for token in decoder.tokens(t.as_py() or ""):
                    found = known.get(token)
                    if found is None:
                        if len(known) > REMEMBERED:
                            known.clear()
                        found = known[token] = tuple(w for w in decoder.token_terms(token) if w in weight)
                    if found:
                        hits.update(found)
                z = base + math.fsum(weight[w] for w in hits)
                out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
            yield pa.array(out, pa.float64())

    return score


def train(examples: DataFrame, vocabulary: int = 4096) -> tuple[float, dict[str, float]]:
    """Intercept and weights from (terms, label 0/1) rows.

    Terms that lean towards label 1 by a factor of four and occur there twice enter,
    the strongest `vocabulary` of them. With no such term, or one label only, the
    intercept alone is given.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    examples = stage(examples, "examples")
    n, ones = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    base = math.log((ones + 0.5) / (n - ones + 0.5)) if n else math.log(0.5 / 99.5)
    if not n or ones in (0, n):
        return min(base, 0.0), {}
    by_term = examples.select(F.explode("terms").alias("term"), "label").groupBy("term").agg(
        F.sum("label").alias("ones"), F.count(F.lit(1)).alias("all"))
    lean = (F.col("ones") / ones) / ((F.col("all") - F.col("ones") + 0.5) / (n - ones))
    chosen = by_term.filter((F.col("ones") >= 2) & (lean >= 4)).orderBy(
        (F.col("ones") * F.log(lean)).desc(), "term").limit(vocabulary)
    words = [r["term"] for r in chosen.select("term").collect()]
    if not words:
        return base, {}
    vectors = CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="features", minTF=1.0)
    fit = LogisticRegression(regParam=2e-6, maxIter=100, standardization=False).fit(
        vectors.transform(examples).select("features", F.col("label").cast("double").alias("label")))
    weights = {w: float(c) for w, c in zip(words, fit.coefficients.toArray()) if abs(c) > 1e-6}
    return float(fit.intercept), weights


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(True))


def score_column(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Column:
    """Learn from `docs` and `labels`; gives the score of a row of `docs` by its text.

    Labels other than 0 and 1, and rows without label or doc_id, teach nothing; a
    document labelled twice teaches by its largest label.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = spark.sparkContext.broadcast(character_model(texts))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    some = texts.join(F.broadcast(sample), "doc_id")  # at most sample_rows narrow rows
    weights = spark.sparkContext.broadcast(train(some.select(terms_udf(model)("text").alias("terms"), "label")))
    return score_udf(model, weights)(F.col("text").cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """`docs` with the columns held_out, score and predicted, which replace others of these names.

    Every row is scored on its whole text; null and empty texts get the score of no
    term. Repeated rows get equal scores.
    """
    scored = docs.withColumn("score", score_column(docs, labels, sample_rows))
    return scored.withColumn("held_out", held_out()).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast(ST.IntegerType()))
