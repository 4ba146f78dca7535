"""Quality classifier by co-training of a text view and a page-metadata view.

Both views of all documents are worked out once and written to the shared folder in half precision.
The views are fitted to a bounded sample of labelled documents; then, round by round, both views
score all unlabelled documents on the executors, and the ones that each view is surest of, a bounded
number a label, are labelled for the other view.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .resident import resident
from .scratch import Scratch
from .toxicity import held_out

BUCKETS = 1024
NAMES = 32
FACTS = 10
TEXT_SIZE = BUCKETS + 3
META_SIZE = FACTS + 2 * NAMES
LABELLED = 4000
LEAST = 20
ROUNDS = 5
CONFIDENT = 0.97
GIVEN = 200
CACHE = 300_000


class Runs(dict):
    """Row numbers of runs between white space; ``table`` has the buckets of a run's word and shape."""

    def __init__(self) -> None:
        super().__init__()
        self.table = np.zeros((1024, 2), dtype=np.int64)

    def __missing__(self, run: str) -> int:
        shape, last = [], ""
        for c in run:
            kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
            if kind != last:
                shape.append(kind)
            last = kind
        at = self[run] = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        half = BUCKETS // 2
        self.table[at] = [zlib.crc32(x.encode("utf-8", "replace")) % half for x in (run.lower(), "".join(shape))]
        return at

    def of(self, text: str) -> np.ndarray:
        if len(self) > CACHE:
            self.clear()
            self.table = self.table[:1024]
        runs = text.split()
        return np.fromiter(map(self.__getitem__, runs), dtype=np.int64, count=len(runs))


def text_view(text: str) -> np.ndarray:
    """Square roots of the shares of hashed words and word shapes, and how much the text repeats itself."""
    known, half = resident("quality", Runs), BUCKETS // 2
    at = known.of(text)
    out = np.zeros(TEXT_SIZE, dtype=np.float32)
    if not len(at):
        return out
    own, seen = np.unique(at, return_counts=True)
    word, shape = known.table[own].T
    out[:half] = np.sqrt(np.bincount(word, weights=seen, minlength=half) / len(at))
    out[half:BUCKETS] = np.sqrt(np.bincount(shape, weights=seen, minlength=half) / len(at))
    out[BUCKETS:] = len(seen) / len(at), seen.max() / len(at), 1.0
    return out


def meta_view(text: str, lang: str | None, source: str | None, n_chars: float) -> np.ndarray:
    """What is known of a page without its words: size, lines, kinds of characters, language, source."""
    out = np.zeros(META_SIZE, dtype=np.float32)
    size = len(text)
    lines = text.split("\n")
    ascii_ = np.frombuffer(text.encode("ascii", "replace"), dtype=np.uint8)
    kinds = np.bincount(ascii_, minlength=128)[:128] / max(1, size)
    out[:FACTS] = (
        np.log1p(n_chars if n_chars == n_chars and n_chars > 0 else size) / 10, np.log1p(len(lines)) / 5,
        np.log1p(size / len(lines)) / 8, len(set(lines)) / len(lines), kinds[65:91].sum() * 5, kinds[97:123].sum(),
        kinds[48:58].sum() * 5, kinds[32] * 3, (kinds[33:48].sum() + kinds[58:65].sum()) * 5, kinds[91:97].sum() * 5 + kinds[123:].sum() * 5,
    )
    out[FACTS + zlib.crc32(str(lang).encode()) % NAMES] = 1
    out[FACTS + NAMES + zlib.crc32(str(source).encode()) % NAMES] = 1
    return out


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(p) - np.log1p(-p)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 250, rate: float = 0.05, start: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression, by full-batch Adam from ``start`` on."""
    x, y = np.ascontiguousarray(x, dtype=np.float32), y.astype(np.float32)
    w = np.zeros(x.shape[1] + 1, dtype=np.float32) if start is None else start.astype(np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1 if start is None else steps // 2 + 1):
        off = _sigmoid(x @ w[:-1] + w[-1]) - y
        g = np.append(off @ x / np.float32(len(y)) + np.float32(l2) * w[:-1], off.mean(dtype=np.float32))
        m, v = np.float32(0.9) * m + np.float32(0.1) * g, np.float32(0.999) * v + np.float32(0.001) * g * g
        w = w - np.float32(rate / (1 - 0.9**t)) * m / (np.sqrt(v / np.float32(1 - 0.999**t)) + np.float32(1e-8))
    return w.astype(np.float64)


def _apply(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class CoTrained:
    """Both views' weights, their calibrations (scale, offset) and the weights of the combination."""

    text: np.ndarray
    meta: np.ndarray
    text_fit: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0]))
    meta_fit: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0]))
    both: np.ndarray = field(default_factory=lambda: np.array([0.5, 0.5, 0.0]))

    def views(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probabilities of each view."""
        return (
            _sigmoid(_apply(self.text_fit, _apply(self.text, a)[:, None])),
            _sigmoid(_apply(self.meta_fit, _apply(self.meta, b)[:, None])),
        )

    def score(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        z = np.stack([_logit(np.clip(x, 1e-6, 1 - 1e-6)) for x in (p, q)], axis=1)
        return _sigmoid(_apply(self.both, z))


def _fitted(xs: list[np.ndarray], ys: list[np.ndarray], held: tuple[np.ndarray, np.ndarray, np.ndarray], before: CoTrained | None) -> CoTrained:
    """Both views learnt, from the weights ``before`` on, and calibrated on the rows ``held``."""
    starts = (before.text, before.meta) if before else (None, None)
    made = CoTrained(*(logistic(x, y, start=w) for x, y, w in zip(xs, ys, starts)))
    a, b, y = held
    made.text_fit = logistic(_apply(made.text, a)[:, None], y)
    made.meta_fit = logistic(_apply(made.meta, b)[:, None], y)
    return made


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, surest, rounds: int = ROUNDS) -> CoTrained:
    """Co-training on labelled views ``a`` and ``b``.

    ``surest(model)`` gives, for each view, the unlabelled rows it is surest of that were not given
    before, as (text views, metadata views, labels); the other view learns from them.  A fifth of the
    labelled rows is kept for calibrating the views and weighing them.
    """
    hold = np.arange(len(y)) % 5 == 0
    if len(y) < LEAST or len(np.unique(y[~hold])) < 2 or len(np.unique(y[hold])) < 2:
        return constant(float(y.mean()) if len(y) else 0.5)
    xs, ys, held = [a[~hold], b[~hold]], [y[~hold], y[~hold]], (a[hold], b[hold], y[hold])
    made = _fitted(xs, ys, held, None)
    for _ in range(rounds):
        grown = False
        for view, (text, meta, labels) in enumerate(surest(made)):
            other = 1 - view
            xs[other] = np.concatenate([xs[other], (text, meta)[other]])
            ys[other] = np.concatenate([ys[other], labels])
            grown |= len(labels) > 0
        if not grown:
            break
        made = _fitted(xs, ys, held, made)
    p, q = made.views(*held[:2])
    made.both = logistic(np.stack([_logit(np.clip(x, 1e-6, 1 - 1e-6)) for x in (p, q)], axis=1), held[2], l2=1e-2)
    return made


def constant(share: float) -> CoTrained:
    """A model that scores every row alike."""
    weights = [np.zeros(size + 1) for size in (TEXT_SIZE, META_SIZE)]
    for w in weights:
        w[-1] = _logit(np.array([np.clip(share, 1e-3, 1 - 1e-3)]))[0]
    return CoTrained(*weights)


def views(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, doc_id, text_view, meta_view) of every row of ``docs``, the views as half-precision bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 1024):
                part = b.iloc[at : at + 1024]
                rows = zip(part["text"], part["lang"], part["source"], part["n_chars"])
                made = [(text_view(r[0]).astype(np.float16).tobytes(), meta_view(*r).astype(np.float16).tobytes()) for r in rows]
                yield pd.DataFrame({"doc_id": part["doc_id"], "text_view": [x for x, _ in made], "meta_view": [x for _, x in made]})

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.col("n_chars").cast("double").alias("n_chars"),
    )
    made = picked.mapInPandas(run, "doc_id long, text_view binary, meta_view binary")
    return scratch.save(made.withColumn("row", F.monotonically_increasing_id()), "views")


def _matrices(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    sizes = {"text_view": TEXT_SIZE, "meta_view": META_SIZE}
    return tuple(np.frombuffer(b"".join(b[c]), dtype=np.float16).reshape(-1, n).astype(np.float32) for c, n in sizes.items())


def scored(made: DataFrame, model: CoTrained) -> DataFrame:
    """(row, doc_id, text_score, meta_score, score) of a table of views."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p, q = model.views(*_matrices(b))
            yield pd.DataFrame({"row": b["row"], "doc_id": b["doc_id"], "text_score": p, "meta_score": q, "score": model.score(p, q)})

    return made.mapInPandas(run, "row long, doc_id long, text_score double, meta_score double, score double")


def fit(
    made: DataFrame, labels: DataFrame, scratch: Scratch, label_col: str = "quality", labelled: int = LABELLED, given: int = GIVEN
) -> CoTrained:
    """Learns from views.

    At most ``labelled`` labelled ids are picked by a hash order, and of rows with one id the
    first; in each round every unlabelled row is scored and at most ``given`` rows of each label are
    taken from each view, of equally sure ones those with smaller ids.  All are outside the held-out
    fold.  What comes to the driver is bounded by these two numbers.
    """
    fold = F.col("doc_id").isNotNull() & ~held_out("doc_id")
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = named.where(fold & F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    picked = made.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min_by(F.struct("text_view", "meta_view", "label"), "row").alias("own"))
    rows = picked.select("doc_id", "own.*").toPandas().sort_values("doc_id")
    taken: list[int] = []

    def surest(model: CoTrained) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        own = scored(made, model).where(fold & (F.greatest("text_score", "meta_score", 1 - F.col("text_score"), 1 - F.col("meta_score")) >= CONFIDENT))
        free = own.join(named.select("doc_id").distinct(), "doc_id", "left_anti")
        if taken:
            free = free.join(F.broadcast(made.sparkSession.createDataFrame([(i,) for i in taken], "row long")), "row", "left_anti")
        free = scratch.save(free.drop("score"), f"sure_{len(taken)}")
        parts = []
        for view, column in enumerate(("text_score", "meta_score")):
            for label, sure in ((1.0, F.col(column)), (0.0, 1 - F.col(column))):
                ranked = free.select("row", "doc_id", sure.alias("sure")).where(F.col("sure") >= CONFIDENT)
                parts.append(ranked.orderBy(F.desc("sure"), "doc_id", "row").limit(given).select("row", F.lit(view).alias("view"), F.lit(label).alias("label")))
        chosen = parts[0]
        for p in parts[1:]:
            chosen = chosen.unionByName(p)
        # a row that both views are sure of goes to the metadata view, from the text view
        chosen = chosen.groupBy("row").agg(F.min(F.struct("view", "label")).alias("own")).select("row", "own.*")
        found = made.join(F.broadcast(chosen), "row").select("row", "text_view", "meta_view", "view", "label").toPandas().sort_values("row")
        taken.extend(found["row"].tolist())
        return [(*_matrices(x), x["label"].to_numpy(np.float64)) for x in (found[found["view"] == v] for v in (0, 1))]

    return co_train(*_matrices(rows), rows["label"].to_numpy(np.float64), surest)


def quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, text_score, meta_score, score, predicted) for every row of ``docs``.

    ``docs``: doc_id, text, lang, source, n_chars; ``labels``: doc_id and a 0/1 column.  Null texts
    count as empty and are scored like others, very long ones whole; null lang, source and n_chars are
    values of their own; repeated rows score alike; labels that are null or of null ids count for
    nothing, and an id labelled twice counts with the larger.  With fewer than ``LEAST`` labels, or of
    one kind only, every row scores their share (0.5 without any).  An empty table gives an empty
    result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    made = views(docs, scratch)
    return scored(made, fit(made, labels, scratch, label_col)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "text_score", "meta_score", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_quality_cotraining(spark, sf_dir: str) -> DataFrame:
    """Scores all ``documents`` with the labels of ``labels``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
