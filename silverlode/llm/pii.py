"""Personal data by bootstrapped contextual extraction: known entities teach contexts, sure contexts find new entities."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import give_back, kept, stored

KINDS = ("email", "ip", "card", "phone")

# A context becomes a pattern of a kind when it holds so many different entities of it, and they are
# so large a share of all the different things it holds.
LEAST_ENTITIES = 5
LEAST_SHARE = 0.9
# An unseen identifier is taken when the patterns around it, as independent witnesses, trust it so much.
LEAST_TRUST = 0.95
ROUNDS = 3
# Digits that a token needs to be a candidate anywhere; tokens with an at sign inside need none. In the slot of a pattern,
# anything is one.
LEAST_DIGITS = 5
# Words that a slot holds at most.
MOST_WORDS = 5
# How far a pattern is trusted on a span that has so many digits or an at sign, only fewer digits, or neither.
WEIGHTS = (1.0, 0.7, 0.3)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken whole and from its start, so that one that leads nowhere is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_WORD = re.compile(r"\S+")
_LIKELY = re.compile(r"[0-9@]|[\[({<]\w+[\])}>]")
_AT = re.compile(r"[\[({<]\w+[\])}>]")
_PAIRS = dict(zip("([{<", ")]}>", strict=True))
_TRIM = ".,;:!?\"'()[]{}<>*#$%&|"

_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())])
_SIGHT = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("entity", T.LongType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("contexts", T.ArrayType(T.LongType())),
    ]
)
_FOUND = [T.StructField("base", T.ArrayType(_SPAN)), T.StructField("base_sha256", T.StringType()), T.StructField("seen", T.ArrayType(_SIGHT))]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign back over what a name may hold, then on over the domain: each sign is read once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in ``KINDS``, end) of all that the kinds' own patterns match and their checks pass, in order.

    Within a kind, matches are leftmost and do not overlap; one that fails its check is dropped.
    """
    if not _HINT.search(text):
        return []
    spans = [(start, 0, end) for start, end in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _candidates(text: str, known: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens with enough digits, or an at sign inside, that touch no known span."""
    covered = sorted((s, e) for s, _, e in known)
    place = at = 0
    while hint := _HINT.search(text, at):
        start = hint.start()
        while start > at and not _SPACE.match(text[start - 1]):
            start -= 1
        space = _SPACE.search(text, hint.start())
        end = at = space.start() if space else len(text)
        while start < end and text[start] in _TRIM:
            start += 1
        while end > start and text[end - 1] in _TRIM:
            end -= 1
        while place < len(covered) and covered[place][1] <= start:
            place += 1
        token = text[start:end]
        if "@" in token[1:-1] or len(_digits(token)) >= LEAST_DIGITS:
            if not any(s < end and start < e for s, e in covered[place : place + len(KINDS)]):
                yield start, end


def _weight(entity: str) -> float:
    """How much a span looks like an identifier of any kind, whatever its form."""
    digits = len(_digits(entity))
    if digits >= LEAST_DIGITS or "@" in entity[1:-1] or any(_AT.fullmatch(w) for w in entity.split()[1:-1]):
        return WEIGHTS[0]
    return WEIGHTS[1] if digits else WEIGHTS[2]


def _plain(words: list[str]) -> list[str]:
    return [w for w in (w.strip(_TRIM) for w in words) if w]


def _pattern(kind: str, one: str, two: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}\t{one}\t{two}") - (1 << 63)


def _contexts(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """The lexical patterns that a span stands in: ("2", two words before) and ("1", the word before, the word behind)."""
    before = _plain(text[max(0, start - 80) : start].lower().split())[-2:]
    after = _plain(text[end : end + 40].lower().split())[:1]
    found = [("2", *before)] if len(before) == 2 else []
    if before and after:
        found.append(("1", before[-1], after[0]))
    return found


class Patterns:
    """Patterns by the word before their slot. ``full`` are the words whose slots are wanted whatever stands in them."""

    def __init__(self, patterns: Iterable[tuple[str, str, str]]) -> None:
        self.before: dict[str, set[str]] = {}
        self.behind: dict[str, set[str]] = {}
        self.open: dict[str, int] = {}
        self.every = frozenset(patterns)
        for kind, one, two in self.every:
            by, anchor, other = (self.before, two, one) if kind == "2" else (self.behind, one, two)
            by.setdefault(anchor, set()).add(other)
            self.open[anchor] = self.open.get(anchor, 0) + 1
        self.anchors = frozenset(self.open)
        self.full = set(self.anchors)

    def enough(self, pattern: tuple[str, str, str]) -> None:
        """From now on this pattern's slots are only wanted where something like an identifier is near."""
        anchor = pattern[2] if pattern[0] == "2" else pattern[1]
        self.open[anchor] -= 1
        if not self.open[anchor]:
            self.full.discard(anchor)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the signs around it, but for brackets that open and close within it."""
    while start < end and text[start] in _TRIM and _PAIRS.get(text[start], "\0") not in text[start:end]:
        start += 1
    opens = {close: open_ for open_, close in _PAIRS.items()}
    while end > start and text[end - 1] in _TRIM and opens.get(text[end - 1], "\0") not in text[start:end]:
        end -= 1
    return start, end


def _run(words: list[str]) -> int:
    """How many words a slot without an end holds: those with digits or an at sign, and those joined by a word in brackets."""
    n = 1
    while n < len(words) and words[n - 1][-1] not in ",;:!?.":
        if _AT.fullmatch(words[n]) and n + 1 < len(words):
            n += 2
        elif _HINT.search(words[n]) and _HINT.search(words[n - 1]):
            n += 1
        else:
            break
    return n


def _slots(text: str, known: list[tuple[int, int, int]], patterns: Patterns) -> Iterator[tuple[int, int, tuple[str, str, str]]]:
    """Spans of up to ``MOST_WORDS`` words that stand after or between the words of ``patterns`` and touch no known span."""
    if not patterns.anchors or not text:
        return
    plain = [w.strip(_TRIM) for w in text.lower().split()]
    if patterns.anchors.isdisjoint(plain):
        return
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(plain):  # lower case has made white space
        plain = [text[s:e].lower().strip(_TRIM) for s, e in places]
    covered = sorted((s, e) for s, _, e in known)
    likely: set[int] = set()
    for m in _LIKELY.finditer(text):
        at = bisect.bisect_right(places, (m.start(), len(text) + 1)) - 1
        likely.update(range(at - MOST_WORDS, at))
    full, anchors = patterns.full, patterns.anchors
    for i, word in enumerate(plain[:-1]):
        if word not in full and (i not in likely or word not in anchors):
            continue
        found = []
        behind = patterns.behind.get(word)
        if behind:
            for j in range(i + 2, min(i + 2 + MOST_WORDS, len(plain))):
                if plain[j] in behind:
                    found.append((j - i - 1, ("1", word, plain[j])))
                    break
        if i and plain[i - 1] in patterns.before.get(word, ()):
            found.append((_run([text[s:e] for s, e in places[i + 1 : i + 1 + MOST_WORDS]]), ("2", plain[i - 1], word)))
        for size, pattern in found:
            start, end = _trimmed(text, places[i + 1][0], places[i + size][1])
            at = bisect.bisect_left(covered, (start, start))
            near = covered[max(0, at - len(KINDS)) : at] + covered[at : at + 1]
            if start < end and not any(s < end and start < e for s, e in near):
                yield start, end, pattern


def _entity(span: str) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(span.lower().split())) - (1 << 63)


def _scan(text: str, patterns: Patterns) -> tuple[list, str, list]:
    base = base_spans(text)
    digest = hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
    unknown = dict.fromkeys([*_candidates(text, base), *((s, e) for s, e, _ in _slots(text, base, patterns))])
    seen = [
        {
            "start": s,
            "end": e,
            "kind": k,
            "entity": _entity(text[s:e]),
            "weight": _weight(text[s:e]),
            # Of other patterns it is not known what else they hold.
            "contexts": [_pattern(*c) for c in _contexts(text, s, e) if c in patterns.every],
        }
        for s, e, k in [*((s, e, k) for s, k, e in base), *((s, e, -1) for s, e in unknown)]
    ]
    return [{"start": s, "kind": k, "end": e} for s, k, e in base], digest, seen


def _patterns(docs: DataFrame) -> list[tuple[str, str, str]]:
    """The patterns that may come to be sure: they hold enough different entities or candidates, and not too much else.

    Each stands for ``LEAST_ENTITIES`` entities at least, so there are far fewer than base spans and candidates. A second pass
    leaves out those that hold so many ordinary words in a single task that no share of the rest could make them sure.
    """

    def stand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("pii")
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                text = t.as_py() or ""
                base = base_spans(text)
                for s, e in [*((s, e) for s, _, e in base), *_candidates(text, base)]:
                    rows += [(*c, _entity(text[s:e])) for c in _contexts(text, s, e)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([r[i] for r in rows], pa.string()) for i in range(3)], pa.array([r[3] for r in rows], pa.int64())],
                ["sort", "one", "two", "entity"],
            )
        give_back()

    words = ("sort", "one", "two")
    given = docs.select("text")
    rows = (
        given.mapInArrow(stand, "sort string, one string, two string, entity long")
        .groupBy(*words)
        .agg(F.count_distinct("entity").alias("n"))
        .where(F.col("n") >= LEAST_ENTITIES)
        .toArrow()
    )
    held = dict(zip(zip(*[rows.column(c).to_pylist() for c in words]), rows.column("n").to_pylist(), strict=True))
    if not held:
        return []
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("pii")
        patterns = Patterns(sent.value)
        ordinary: dict[tuple, set[int]] = {}
        likely: dict[tuple, set[int]] = {}
        for batch in batches:
            for t in batch.column("text"):
                text = t.as_py() or ""
                for s, e, pattern in _slots(text, base_spans(text), patterns):
                    if _weight(text[s:e]) > WEIGHTS[2]:
                        likely.setdefault(pattern, set()).add(_entity(text[s:e]))
                        continue
                    own = ordinary.setdefault(pattern, set())
                    # Fewer leave common patterns in, as what is likely is summed over tasks and this is not.
                    most = sent.value[pattern] + 16
                    if len(own) < most:
                        own.add(_entity(text[s:e]))
                        if len(own) == most:
                            patterns.enough(pattern)
        every = list(ordinary.keys() | likely.keys())
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array([p[i] for p in every], pa.string()) for i in range(3)],
                pa.array([len(ordinary.get(p, ())) for p in every], pa.int64()),
                pa.array([len(likely.get(p, ())) for p in every], pa.int64()),
            ],
            [*words, "ordinary", "likely"],
        )

    rows = (
        given.mapInArrow(fill, "sort string, one string, two string, ordinary long, likely long")
        .groupBy(*words)
        .agg(F.max("ordinary").alias("ordinary"), F.sum("likely").alias("likely"))
        .toArrow()
        .to_pylist()
    )
    sent.destroy()
    for r in rows:
        pattern = (r["sort"], r["one"], r["two"])
        known = held[pattern] + r["likely"]
        if known < LEAST_SHARE * (known + r["ordinary"]):
            del held[pattern]
    return list(held)


def _scanned(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The row in a struct with a number, its base spans and digest, and all that was seen with its contexts."""
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        F.col("text"),
        F.monotonically_increasing_id().alias("number"),
    )
    schema = T.StructType([given.schema["row"], T.StructField("number", T.LongType()), *_FOUND])
    sent = docs.sparkSession.sparkContext.broadcast(_patterns(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kept("pii")
        types = to_arrow_schema(T.StructType(_FOUND))
        patterns = Patterns(sent.value)
        for batch in batches:
            found = [_scan(t.as_py() or "", patterns) for t in batch.column("text")]
            arrays = [pa.array([f[i] for f in found], types.field(i).type) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("number"), *arrays], ["row", "number", *types.names]
            )
        give_back()

    return given.mapInArrow(run, schema)


def _unseen(edges: DataFrame, rounds: int) -> DataFrame:
    """(entity, kind) of what the patterns find, from the graph's distinct edges (context, entity, weight, kind; -1: unknown).

    In each round contexts are scored by the trust in the entities that they hold, and those that are sure enough pass
    trust on to the unknown ones. What looks like no identifier makes no pattern surer. Both sides are sums over edges, so a very common context is combined before it moves.
    """
    seeds = edges.where("kind >= 0").select("entity", "kind").distinct()
    unknown = stored(edges.where("kind < 0").join(seeds, "entity", "left_anti").select("context", "entity", "weight"), "unknown")
    held = stored(
        edges.groupBy("context").agg(
            *[F.count_distinct(F.when(F.col("kind") == k, F.col("entity"))).alias(f"seeds{k}") for k in range(len(KINDS))]
        ),
        "contexts",
    )
    # Contexts that hold nothing unknown have nothing to pass on.
    holding = unknown.groupBy("context").agg(F.count(F.lit(1)).alias("open")).join(held, "context")
    trusted = None
    for _ in range(rounds):
        scored = holding
        if trusted is not None:
            learnt = (
                unknown.where(F.col("weight") > WEIGHTS[2])
                .join(trusted, "entity")
                .groupBy("context")
                .agg(*[F.sum(F.when(F.col("kind") == k, F.col("trust"))).alias(f"more{k}") for k in range(len(KINDS))])
            )
            scored = holding.join(learnt, "context", "left")
        scores = []
        for k in range(len(KINDS)):
            more = F.lit(0.0) if trusted is None else F.coalesce(f"more{k}", F.lit(0.0))
            everything = sum((F.col(f"seeds{i}") for i in range(len(KINDS))), F.col("open"))
            scores.append(
                F.struct(
                    ((F.col(f"seeds{k}") + more) / everything).alias("share"),
                    (F.col(f"seeds{k}") + more).alias("known"),
                    F.lit(k).alias("kind"),
                )
            )
        sure = scored.select("context", F.greatest(*scores).alias("best")).where(
            (F.col("best.share") >= LEAST_SHARE) & (F.col("best.known") >= LEAST_ENTITIES)
        )
        doubt = F.greatest(1 - F.col("best.share") * F.col("weight"), F.lit(1e-6))
        trusted = stored(
            unknown.join(sure, "context")
            .groupBy("entity", F.col("best.kind").alias("kind"))
            .agg((1 - F.exp(F.sum(F.log(doubt)))).alias("trust"))
            .groupBy("entity")
            .agg(F.max(F.struct("trust", "kind")).alias("most"))
            .select("entity", "most.kind", "most.trust"),
            "trusted",
        )
    return trusted.where(F.col("trust") >= LEAST_TRUST).select("entity", F.col("kind").alias("found_kind"))


def find(docs: DataFrame, carried: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with base_sha256, base and spans: arrays of (start, kind, end) in code points, in order.

    One pass over the texts finds the base entities (email, ip, card, phone) with the lexical patterns they stand in: the two
    words before, or the word on either side. A second one finds whatever stands in the slots of patterns that hold enough
    entities, up to five words of any form, and tokens with digits or an at sign anywhere. The graph of patterns and entities is
    scored in ``rounds`` rounds of Spark joins; base entities are its seeds, ordinary words in a slot count against its pattern, and a
    pattern is trusted less on spans that do not look like identifiers. What sure patterns hold is found wherever it is seen, and
    added to ``spans`` under the patterns' kind; base spans stay.

    A null text is an empty one; null and repeated ids are rows like others; an empty table gives no rows. Only columns
    named in ``carried`` (all, by default) come back; one named base, base_sha256 or spans is replaced.
    """
    carried = [c for c in carried or docs.columns if c not in ("base", "base_sha256", "spans")]
    scanned = stored(_scanned(docs, carried), "scanned")
    seen = scanned.select("number", F.explode("seen").alias("s")).select("number", "s.*")
    edges = stored(seen.select(F.explode("contexts").alias("context"), "entity", "weight", "kind").distinct(), "edges")
    extra = (
        seen.where("kind < 0")
        .join(_unseen(edges, rounds), "entity")
        .groupBy("number")
        .agg(F.collect_set(F.struct("start", F.col("found_kind").alias("kind"), "end")).alias("extra"))
    )
    spans = F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(T.ArrayType(_SPAN)))))
    return scanned.join(extra, "number", "left").select("row.*", "base_sha256", "base", spans.alias("spans"))


def listed(spans: str):
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redacted(found: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``find`` with every span of a text replaced by its kind in angle brackets; overlaps go as one, under the first kind.

    ``n_chars``, where it is among ``columns``, is counted anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                parts, at = [], 0
                for span in spans if text else ():
                    if span["start"] >= at:
                        parts += [text[at : span["start"]], f"<{KINDS[span['kind']].upper()}>"]
                    at = max(at, span["end"])
                texts.append("".join([*parts, text[at:]]) if text else text)
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, columns)
        give_back()

    schema = T.StructType([found.schema[c] for c in columns])
    out = found.select(*[f"`{c}`" for c in columns], "spans").mapInArrow(run, schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*[f"`{c}`" for c in columns])
