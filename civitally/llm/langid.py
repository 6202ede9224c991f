"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords, the 2- to 4-byte strings inside
space-padded words, hashed into ``BUCKETS`` rows. The classifier is trained in numpy by
stochastic gradient descent on a sample of at most ``TRAIN_ROWS`` labelled rows, spread
evenly over the languages, each seen whole and as a short snippet. Executors turn the
sampled texts into bucket counts, so the driver holds counts, never texts.

A fifth of the sample is kept back: on it the softmax temperature is fitted and the
rejection threshold is set so that at most ``FALSE_REJECT`` of the rightly named rows fall
below it, and never above ``SURE``. Scores are the calibrated probability of the language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import local_table
from .common import record_batch, unwrapped, utf8, whole_rows

BUCKETS = 8192
DIM = 24
TRAIN_ROWS = 4000
LEAST_ROWS = 8
EPOCHS = 12
BATCH = 32
RATE = 40.0
SNIPPET_WORDS = 8
FALSE_REJECT = 0.002
SURE = 0.5
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
_CHUNK = 1 << 18

#: ASCII letters in lower case and all bytes beyond ASCII; anything else is a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learned from; a null id is neither learned from nor held out."""
    fold = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def bucket_counts(text: bytes) -> np.ndarray:
    """How often each bucket's subwords occur in a UTF-8 text."""
    padded = np.frombuffer(b" " + text.translate(_LETTERS) + b" ", np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(padded), _CHUNK):
        part = padded[at : at + _CHUNK + 3]
        own = len(part) if at + _CHUNK >= len(padded) else _CHUNK
        letter, code = part != 32, part.astype(np.uint32)
        rolled, inside = code, None
        for n in (2, 3, 4):
            if len(part) < n:
                break
            rolled = rolled[:-1] * np.uint32(0x01000193) ^ code[n - 1 :]
            if n == 2:
                valid = letter[:-1] | letter[1:]
            else:  # no blank inside, so a subword lies in one word and its borders
                inner = letter[1 : len(letter) - n + 2]
                inside = inner if inside is None else inside[:-1] & letter[n - 2 : len(letter) - 1]
                valid = inside
            found = rolled[:own][valid[:own]] + np.uint32(n)
            counts += np.bincount((found * np.uint32(2654435761)) >> 19, minlength=BUCKETS)
    return counts


def has_letter(text: bytes) -> bool:
    folded = text.translate(_LETTERS)
    if not folded.strip():
        return False
    return any(97 <= b <= 122 for b in folded) or any(map(str.isalpha, text.decode("utf-8", "replace")))


@dataclass
class Model:
    """Embeddings and softmax are linear, so they are multiplied into one bucket table."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum(axis=-1, keepdims=True)
        logits = (counts @ self.table) / np.maximum(total, 1) + self.bias
        e = np.exp((logits - logits.max(axis=-1, keepdims=True)) / self.temperature)
        return e / e.sum(axis=-1, keepdims=True)

    def name(self, text: bytes) -> tuple[str, float, bool]:
        """Language, score and whether the text is rejected."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        p = self.probabilities(bucket_counts(text).astype(np.float32))
        best = int(p.argmax())
        score = float(min(1.0, p[best]))
        return self.languages[best], score, score < self.threshold


_SAMPLE = pa.schema(
    [("lang", pa.string()), ("order", pa.int64()), ("check", pa.bool_()), ("buckets", pa.binary()), ("counts", pa.binary())]
)


def _sampled_counts(docs: DataFrame) -> DataFrame:
    """Sparse bucket counts of sampled rows and of a snippet of each."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: tuple[list, ...] = ([], [], [], [], [])
            for lang, order, text in zip(part["lang"].to_pylist(), part["order"].to_pylist(), part["text"]):
                text = text.as_py()
                words = text.split()
                at = abs(order) % max(1, len(words) - SNIPPET_WORDS + 1)
                check = order % 5 == 0
                for view in (text, b" ".join(words[at : at + SNIPPET_WORDS])):
                    counts = bucket_counts(view)
                    used = np.flatnonzero(counts)
                    if len(used):
                        row = (lang, order, check, used.astype("<u2").tobytes(), counts[used].astype("<f4").tobytes())
                        for column, value in zip(out, row):
                            column.append(value)
            yield record_batch(_SAMPLE, *out)

    return docs.mapInArrow(run, "lang string, order long, check boolean, buckets binary, counts binary")


def _dense(rows: list, at: np.ndarray) -> np.ndarray:
    x = np.zeros((len(at), BUCKETS), np.float32)
    for i, k in enumerate(at):
        used = np.frombuffer(rows[k]["buckets"], "<u2")
        counts = np.frombuffer(rows[k]["counts"], "<f4")
        x[i, used] = counts / counts.sum()
    return x


def fit(rows: list, languages: list[str], seed: int = 7) -> Model:
    """Train on sampled rows (dicts of lang, check, buckets, counts) and calibrate."""
    random = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(languages)}
    label = np.array([number[r["lang"]] for r in rows])
    check = np.array([r["check"] for r in rows])
    train = np.flatnonzero(~check)
    embed = random.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = random.normal(0, 0.1, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, step = EPOCHS * max(1, -(-len(train) // BATCH)), 0
    for _ in range(EPOCHS):
        random.shuffle(train)
        for at in range(0, len(train), BATCH):
            rate = 1 - step / steps
            step += 1
            some = train[at : at + BATCH]
            x = _dense(rows, some)
            hidden = x @ embed
            logits = hidden @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), label[some]] -= 1
            p /= len(some)
            back = p @ soft.T
            soft -= rate * 0.5 * (hidden.T @ p)
            bias -= rate * 0.1 * p.sum(0)
            embed -= rate * RATE * (x.T @ back)
    model = Model(languages, (embed @ soft).astype(np.float32), bias)
    return _calibrated(model, rows, label, np.flatnonzero(check))


def _calibrated(model: Model, rows: list, label: np.ndarray, check: np.ndarray) -> Model:
    if not len(check):
        return model
    logits = np.concatenate(
        [_dense(rows, check[i : i + 256]) @ model.table + model.bias for i in range(0, len(check), 256)]
    )
    truth = label[check]

    def p_at(t: float) -> np.ndarray:
        e = np.exp((logits - logits.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    def loss(t: float) -> float:
        return -np.log(np.maximum(p_at(t)[np.arange(len(truth)), truth], 1e-9)).mean()

    model.temperature = min(np.geomspace(0.2, 5, 33), key=loss)
    p = p_at(model.temperature)
    right = p.max(1)[p.argmax(1) == truth]
    # a value of the sample, so that neither its size nor repeated rows matter
    low = float(np.quantile(right, FALSE_REJECT, method="inverted_cdf")) if len(right) else SURE
    model.threshold = min(low, SURE)
    return model


def train(docs: DataFrame) -> Model:
    """A model from the labelled rows of ``docs`` that are not held out.

    Without such rows the model knows no language and names every text ``und``.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    known = docs.where((fold != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("lang", "text", F.xxhash64("doc_id").alias("order"))
    # texts are counted by distinct ids, which repeated rows do not change
    counts = known.groupBy("lang").agg(F.approx_count_distinct("order").alias("count")).collect()  # a row per label
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    share, parts = max(TRAIN_ROWS / len(languages), LEAST_ROWS), 1 << 20
    cut = {r["lang"]: min(parts, int(parts * share / max(1, r["count"])) + 1) for r in counts}
    cuts = local_table(
        docs.sparkSession,
        T.StructType().add("lang", T.StringType()).add("cut", T.LongType()),
        [list(cut), list(cut.values())],
    )
    near = known.join(F.broadcast(cuts), "lang").where(F.pmod(F.shiftright("order", 8), F.lit(parts)) < F.col("cut"))
    sample = near.select("lang", "order", utf8().alias("text")).dropDuplicates()
    rows = [r.asDict() for r in _sampled_counts(sample).limit(int(4 * share * len(languages))).collect()]
    rows.sort(key=lambda r: (r["order"], r["lang"], bytes(r["buckets"]), bytes(r["counts"])))
    return fit(rows, languages)


def _name(docs: DataFrame, model: Model, carried: list[str], texts: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """The carried columns and the language of each row; ``texts`` takes the texts from a batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            named = [model.name(t.as_py() or b"") for t in texts(part)]
            lang, score, rejected = zip(*named) if named else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [part[c] for c in carried]
                + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*carried, "lang_pred", "score", "rejected"],
            )

    schema = T.StructType([f for f in docs.schema if f.name in carried])
    for name, kind in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per row of ``docs``.

    A null, empty or letterless text is ``und`` with score 0 and rejected. Only the text
    is looked at; repeated rows get the same answer; further columns are ignored.
    """
    rows = docs.select("doc_id", held_out().alias("held_out"), utf8().alias("__utf8"))
    return _name(rows, model, ["doc_id", "held_out"], lambda part: part["__utf8"])


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` whose language is recognised, whatever columns they have."""
    at = [c.lower() for c in docs.columns].index("text")
    # the text goes to Python once, as part of its row
    named = _name(whole_rows(docs), model, ["row"], lambda part: part["row"].field(at).cast(pa.binary()))
    return unwrapped(named.where("not rejected"))
