"""Quality rules: an n-gram model counted by Spark, modified Kneser-Ney, and perplexity bands for each language."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import give_back, kept, stored

ORDER = 3
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
# A text's perplexity is the median of its windows, of about so many characters, so that a passage in another language
# or a list does not move it.
WINDOW = 256
# Fences lie so many interquartile ranges outside the quartiles of a language, and no nearer than so many nats a character.
FENCE = 3.0
LEAST_BELOW = 0.15
LEAST_ABOVE = 0.15
# Grams that one scoring pass holds. Languages are scored in groups within it, and one that has more in parts.
GROUP_ENTRIES = 4_000_000
# Rows with the quartiles of a language that are still broadcast.
BROADCAST_LANGUAGES = 100_000
CHUNK = 1 << 19

# A gram is one number, of 21 bits for each code point.
_BITS = 21
_MASK = (1 << _BITS) - 1
_START = _MASK  # stands before a text; no character has this number
_SPREAD = 1 / (1 << _BITS)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, as one number, and how many each text has. Grams do not cross texts."""
    parts = [_points(t) for t in texts]
    pad = np.full(order - 1, _START, np.int64)
    line = np.concatenate([x for p in parts for x in (pad, p)] or [pad])
    codes = np.zeros(max(0, len(line) - order + 1), np.int64)
    for i in range(order):
        codes = (codes << _BITS) | line[i : i + len(codes)]
    lengths = np.array([len(p) for p in parts], np.int64)
    keep = np.ones(len(codes), bool)  # windows that reach into the next text's start are none
    ends = (lengths + order - 1).cumsum()
    for i in range(1, order):
        keep[ends[:-1] - i] = False
    return codes[keep], lengths


def _windows(length: int) -> np.ndarray:
    """Where the windows of a text begin, and its end; all about as long."""
    n = max(1, length // WINDOW)
    return np.arange(n + 1) * length // n


def _sums(logp: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """For each text the sums over its windows; none for an empty one."""
    total = np.append(0, logp.cumsum())
    starts = np.append(0, lengths.cumsum())
    return [np.diff(total[begin + _windows(n)]) if n else np.empty(0) for begin, n in zip(starts.tolist(), lengths.tolist(), strict=False)]


def _median(sums: np.ndarray, length: int) -> float:
    return float(np.median(-sums / np.diff(_windows(length)))) if length else float("nan")


def _chunks(texts: list[str]) -> Iterator[list[int]]:
    """Places of consecutive texts, a bounded number of characters at a time."""
    at: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if at and size + len(text) > CHUNK:
            yield at
            at, size = [], 0
        at.append(i)
        size += len(text)
    if at:
        yield at


def _language(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def _texts(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch, which come once: in the rows carried, or else beside them."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("row").field("text")


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    """(language, places in the batch, texts), in pieces of bounded size."""
    langs = np.array(batch.column("language").to_pylist(), object)
    texts = _texts(batch).to_pylist()
    for lang in sorted(set(langs.tolist())):
        at = np.flatnonzero(langs == lang)
        own = [texts[i] or "" for i in at]
        for piece in _chunks(own):
            yield lang, at[piece], [own[i] for i in piece]


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(language, gram, n) over all characters of all texts: summed up within a task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("perplexity")
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for lang, _, texts in _by_language(batch):
                codes, counts = np.unique(grams(texts, order)[0], return_counts=True)
                if lang in totals:
                    old, n = totals[lang]
                    codes, place = np.unique(np.concatenate([old, codes]), return_inverse=True)
                    counts = np.bincount(place, np.concatenate([n, counts])).astype(np.int64)
                totals[lang] = codes, counts
        for lang, (codes, counts) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                ["language", "gram", "n"],
            )
        give_back()

    counted = docs.select(_language(F.col("lang")).alias("language"), "text").mapInArrow(
        run, "language string, gram long, n long"
    )
    return counted.groupBy("language", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(language, length, gram, logp, backoff): modified Kneser-Ney from the counts of the longest grams.

    Below the longest grams, counts are numbers of different characters before a gram. Three discounts for each
    language and length come from its counts of counts. ``backoff`` is the weight left to shorter contexts after
    this gram, null where nothing follows it. Single characters are smoothed with an even spread over all numbers of 21 bits,
    the entry of length 0.
    """
    by_length = {order: counts.select("language", "gram", "n")}
    for k in range(order - 1, 0, -1):
        by_length[k] = (
            by_length[k + 1]
            .groupBy("language", F.col("gram").bitwiseAND(F.lit((1 << _BITS * k) - 1)).alias("gram"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
    levels: list[DataFrame] = []
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        own = stored(by_length[k], f"counts{k}")
        met = own.groupBy("language").agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        discounts = met.select(
            "language",
            *[
                F.when(F.col(f"n{i}") > 0, F.least(F.greatest(i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"), F.lit(0.1)), F.lit(i - 0.1)))
                .otherwise(F.lit(i * 0.5))
                .alias(f"d{i}")
                for i in (1, 2, 3)
            ],
        )
        n = F.col("n")
        cut = own.join(discounts, "language").withColumns(
            {
                "context": F.shiftrightunsigned("gram", _BITS),
                "off": F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3")),
            }
        )
        contexts = cut.groupBy("language", "context").agg(
            F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("left")
        )
        here = cut.join(contexts, ["language", "context"])
        if lower is None:
            shorter = here.withColumn("p_lower", F.lit(_SPREAD))
        else:
            shorter = here.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << _BITS * (k - 1)) - 1))).join(
                lower.select("language", F.col("gram").alias("suffix"), F.col("p").alias("p_lower")), ["language", "suffix"]
            )
        scored = stored(
            shorter.select(
                "language",
                "gram",
                ((n - F.col("off")) / F.col("total") + F.col("left") * F.col("p_lower")).alias("p"),
            ),
            f"model{k}",
        )
        # What is left after a context belongs to the entry of the context, one character shorter.
        after = contexts.select("language", F.col("context").alias("gram"), F.log("left").alias("backoff"))
        if k == 1:
            levels.append(after.select("language", "gram", F.lit(float(np.log(_SPREAD))).alias("logp"), "backoff"))
        else:
            levels[-1] = levels[-1].join(after, ["language", "gram"], "full")
        levels.append(scored.select("language", "gram", F.log("p").alias("logp")))
        lower = scored
    levels[-1] = levels[-1].withColumn("backoff", F.lit(None).cast("double"))
    return reduce(
        DataFrame.unionByName, [level.withColumn("length", F.lit(k)) for k, level in enumerate(levels)]
    )


class Model:
    """One language's model: for each length the sorted grams, their log probability and what they leave to shorter ones."""

    def __init__(self, lengths: np.ndarray, codes: np.ndarray, logp: np.ndarray, backoff: np.ndarray) -> None:
        self._levels = {}
        for k in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == k)
            at = at[np.argsort(codes[at], kind="stable")]
            self._levels[k] = codes[at], logp[at].astype(np.float32), backoff[at].astype(np.float32)

    @staticmethod
    def _find(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, codes), max(len(table) - 1, 0))
        return at, table[at] == codes if len(table) else np.zeros(len(codes), bool)

    def logp(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each gram after those before it, by the longest gram known."""
        out = np.zeros(len(codes), np.float64)
        open_ = np.arange(len(codes))
        for k in sorted(self._levels.keys() - {0}, reverse=True):
            table, logp, _ = self._levels[k]
            gram = codes[open_] & ((1 << _BITS * k) - 1)
            at, known = self._find(table, gram)
            known &= ~np.isnan(logp[at]) if len(table) else known
            out[open_[known]] += logp[at[known]]
            open_ = open_[~known]
            if len(open_) and k - 1 in self._levels:
                context = gram[~known] >> _BITS
                table, _, backoff = self._levels[k - 1]
                at, known = self._find(table, context)
                left = np.where(known, backoff[at], 0.0) if len(table) else np.zeros(len(open_))
                out[open_] += np.nan_to_num(left)
        out[open_] += np.log(_SPREAD)
        return out


class Part:
    """The longest grams of one language, or those of them whose number leaves ``part`` by ``parts``, sorted.

    All texts scored were counted, so each of their grams is here, or in another part; those add nothing here.
    """

    def __init__(self, codes: np.ndarray, logp: np.ndarray, part: int = 0, parts: int = 1) -> None:
        order = np.argsort(codes, kind="stable")
        self._codes, self._logp, self._part, self._parts = codes[order], logp[order].astype(np.float32), part, parts

    def logp(self, codes: np.ndarray) -> np.ndarray:
        own = codes % self._parts == self._part
        at = np.searchsorted(self._codes, codes[own])
        if len(at) and (at.max() >= len(self._codes) or (self._codes[at] != codes[own]).any()):
            raise ValueError("a gram was not counted")
        out = np.zeros(len(codes))
        out[own] = self._logp[at]
        return out

    def sums(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        codes, lengths = grams(texts)
        different, place = np.unique(codes, return_inverse=True)
        return _sums(self.logp(different)[place], lengths), lengths


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; see ``rules``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    white = sum(map(text.count, " \t\n\r\x0b\x0c"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        _, place, n = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        again = n[place] > 1
        if again.any():
            covered = np.zeros(len(words), bool)
            for i in range(3):
                covered[i : i + len(again)] |= again
            repeated = int(covered.sum())
    return len(words), len(text) - white, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(docs: DataFrame, models: dict[str, Part], others: set[str] | None = None) -> DataFrame:
    """``docs`` (row, language, print, and text if the row has none) with their counts and perplexity; without text.

    Rows are those of languages with a model, or, if ``others`` are given, of all but these. Where a language has no model
    anywhere, all its texts are empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast((models, others))
    schema = T.StructType(
        [
            docs.schema["row"],
            docs.schema["language"],
            T.StructField("print", T.LongType()),
            *[T.StructField(c, T.LongType()) for c in COUNTS],
            T.StructField("log_perplexity", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("perplexity")
        models, others = sent.value
        for batch in batches:
            langs = batch.column("language").to_pylist()
            own = [lang in models if others is None else lang not in others for lang in langs]
            if not all(own):
                batch = batch.filter(pa.array(own, pa.bool_()))
            median = np.full(batch.num_rows, np.nan)
            for lang, at, texts in _by_language(batch):
                if lang in models:
                    sums, lengths = models[lang].sums(texts)
                    median[at] = [_median(s, n) for s, n in zip(sums, lengths.tolist(), strict=True)]
            counts = np.array([base_counts(t.as_py()) for t in _texts(batch)], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("language"),
                    batch.column("print"),
                    *[pa.array(counts[:, i]) for i in range(len(COUNTS))],
                    pa.array(median, mask=np.isnan(median)),
                ],
                ["row", "language", "print", *COUNTS, "log_perplexity"],
            )
        give_back()

    return docs.mapInArrow(run, schema)


def _in_parts(docs: DataFrame, longest: DataFrame, language: str, parts: int) -> DataFrame:
    """(print, score) of the different texts of one language, whose grams are too many for one pass.

    Each pass holds a part of the grams and adds up what they give to the windows of every text; the sums of all passes
    are added by text.
    """
    texts = docs.where(F.col("language") == language).select("print", "text")
    scored = []
    for part in range(parts):
        rows = longest.where((F.col("language") == language) & (F.pmod("gram", F.lit(parts)) == part)).toArrow()
        sent = docs.sparkSession.sparkContext.broadcast(
            Part(rows.column("gram").to_numpy(), rows.column("logp").to_numpy(), part, parts)
        )

        def run(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            kept("perplexity")
            for batch in batches:
                all_ = batch.column("text").to_pylist()
                for piece in _chunks([t or "" for t in all_]):
                    sums, lengths = sent.value.sums([all_[i] or "" for i in piece])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("print").take(pa.array(piece)),
                            pa.array([s.tolist() for s in sums], pa.list_(pa.float64())),
                            pa.array(lengths),
                        ],
                        ["print", "sums", "length"],
                    )

        passed = texts.mapInArrow(run, "print long, sums array<double>, length long")
        scored.append(stored(passed.groupBy("print").agg(F.first("sums").alias("sums"), F.first("length").alias("length")), "part"))
    added = reduce(DataFrame.unionAll, scored).select("print", "length", F.posexplode("sums").alias("window", "sum"))
    windows = f"greatest(length div {WINDOW}, 1)"
    size = F.expr(f"((window + 1) * length) div {windows} - (window * length) div {windows}")
    each = added.groupBy("print", "length", "window").agg(F.sum("sum").alias("sum"))
    return each.groupBy("print").agg(F.median(-F.col("sum") / size).alias("score"))


def _passes(longest: DataFrame, most: int) -> tuple[list[dict[str, int]], dict[str, int]]:
    """Languages scored together in a pass, as many, in order, as have ``most`` grams in all; and the parts of those with more."""
    passes: list[dict[str, int]] = [{}]
    parts: dict[str, int] = {}
    for row in longest.groupBy("language").count().orderBy("language").toLocalIterator():
        if row["count"] > most:
            parts[row["language"]] = -(-row["count"] // most)
            continue
        if sum(passes[-1].values()) + row["count"] > most:
            passes.append({})
        passes[-1][row["language"]] = row["count"]
    return passes, parts


def rules(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct ``quality``: counts, base_failed, log_perplexity, lower, upper and kept.

    Counts are those of words (runs without ASCII white space): how many, their code points, symbols ``#*$%&|<>``,
    lines with a word that equal an earlier line, and words in three-word windows that the text holds twice.
    base_failed: fewer than 50 words, or more than half of them repeated.

    The model is one of characters, three at a time, counted by Spark over all characters of all texts for each language,
    with modified Kneser-Ney smoothing; null is a language of its own. Perplexity is the mean over a window's characters, in
    nats, and the median over a text's windows. A language's band runs from three interquartile ranges below the quartiles
    of its texts to three above, and at least 0.15 to either side; equal texts count once there, and texts that fail the
    base rules not at all. kept: neither base_failed nor outside the band.

    A pass holds the sorted grams of some languages, four million at most; a language with more is scored in parts.

    A null text is an empty one: no words, base_failed. A very long text is scored in its task's memory. Null and repeated ids
    are rows like others; an empty table gives no rows. Only columns named in ``carried`` (all, by default) come back; one
    named quality is replaced.
    """
    columns = [c for c in carried or docs.columns if c != "quality"]
    model = stored(kneser_ney(count_grams(docs)), "model")
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        _language(F.col("lang")).alias("language"),
        F.xxhash64("text").alias("print"),
        *(["text"] if "text" not in columns else []),
    )
    longest = model.where(F.col("length") == ORDER).select("language", "gram", "logp")
    passes, parts = _passes(longest, GROUP_ENTRIES)
    measured = []
    for i, group in enumerate(passes):
        own = longest
        if parts or len(passes) > 1:  # a name a language, and so no more than grams of a pass
            names = docs.sparkSession.createDataFrame([(lang,) for lang in group], "language string")
            own = longest.join(F.broadcast(names), "language", "left_semi")
        rows = own.toArrow()
        langs = np.array(rows.column("language").to_pylist(), object)
        codes, logp = (rows.column(c).to_numpy() for c in ("gram", "logp"))
        models = {lang: Part(codes[langs == lang], logp[langs == lang]) for lang in group}
        # Languages without grams go with the first pass.
        others = {lang for other in passes[1:] for lang in other} | parts.keys()
        measured.append(_measured(given, models, None if i else others))
    for lang, n in parts.items():
        counted = _measured(given.where(F.col("language") == lang), {}, set()).drop("log_perplexity")
        text = given if "text" in given.columns else given.select("language", "print", F.col("row.text").alias("text"))
        scores = _in_parts(text, longest, lang, n)
        measured.append(counted.join(scores.withColumnRenamed("score", "log_perplexity"), "print", "left").select(measured[0].columns))
    measured = stored(reduce(DataFrame.unionAll, measured), "measured")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    quartiles = stored(
        measured.where(~failed)
        .groupBy("language", "print")
        .agg(F.min("log_perplexity").alias("x"))
        .groupBy("language")
        .agg(F.percentile_approx("x", [0.25, 0.75], 10_000).alias("q"))
        .select("language", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")),
        "quartiles",
    )
    if quartiles.count() <= BROADCAST_LANGUAGES:
        quartiles = F.broadcast(quartiles)
    width = FENCE * (F.col("q3") - F.col("q1"))
    banded = measured.join(
        quartiles.select(
            "language",
            (F.col("q1") - F.greatest(width, F.lit(LEAST_BELOW))).alias("lower"),
            (F.col("q3") + F.greatest(width, F.lit(LEAST_ABOVE))).alias("upper"),
        ),
        "language",
        "left",
    )
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(True))
    return banded.select(
        "row.*",
        F.struct(
            *COUNTS,
            failed.alias("base_failed"),
            "log_perplexity",
            "lower",
            "upper",
            (~failed & inside).alias("kept"),
        ).alias("quality"),
    )
