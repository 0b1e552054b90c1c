"""Language identification with interpolated Kneser-Ney character models, one for each language.

Texts become runs of letters in lower case with one blank between them. Counts of character n-grams up to
``ORDER`` are summed over all training texts by Spark; each partition sends one partial count for a language
and n-gram. No count is dropped: discounts, continuation counts and the alphabet come from all n-grams. Up to
``MAX_GRAMS`` of them the driver builds one sorted hash array for each order with a column of log probabilities
for every language. Beyond, Spark smooths the same way into one stored table for each order; tasks look up the most
frequent n-grams in memory, and a text's other ones are joined with the tables, so both ways give the same scores.
A text's language has the lowest cross-entropy per character.

Rejection: ``accepted`` is false where the entropy margin over the runner-up is below the one at which
training texts reach ``PRECISION``, so it is calibrated on all training rows and on them alone. ``lang_pred`` stays the best
language; it is ``und`` only for texts without any letter.

Defined cases: null text, no letter, or no training row at all: ``und`` with score 0; ties go to the
language that sorts first; rows repeat as given; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.chosen_path import stored
from tradeflow.llm.text import map_texts, slices

#: At most 4: a hash holds 16 bits of each character.
ORDER = 4
#: Rows of language and n-gram of the highest order that a process holds; a larger model stays in stored tables.
MAX_GRAMS = 2_000_000
#: An n-gram counts from so many occurrences in a language's training texts.
MIN_COUNT = 1
#: Share of accepted training texts that must be right.
PRECISION = 0.995
#: Cells of margins that the calibration sums apart.
CELLS = 64
_BLANK = 32


def _letter_table() -> np.ndarray:
    """For every code point below 0x30000: itself in lower case if a letter, else a blank."""
    table = np.full(0x30000, _BLANK, np.uint32)
    for point in range(0x30000):
        ch = chr(point)
        if ch.isalpha():
            low = ch.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


_TABLE: list[np.ndarray] = []


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each one ended by a blank, with runs of other characters as one blank; and text numbers.

    Blanks at the start of a text are left out.
    """
    if not _TABLE:
        _TABLE.append(_letter_table())
    joined = "".join([f"{t} " for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    own = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    low = np.where(points < 0x30000, _TABLE[0][np.minimum(points, 0x2FFFF)], np.uint32(_BLANK))
    blank = low == _BLANK
    first = np.ones(len(low), bool)
    first[1:] = own[1:] != own[:-1]
    before = np.ones(len(low), bool)
    before[1:] = blank[:-1]
    keep = ~(blank & (before | first))
    return low[keep], own[keep]


def gram_keys(points: np.ndarray, own: np.ndarray, order: int) -> np.ndarray:
    """Hash of each character with its ``order - 1`` predecessors in the text (blanks before its start).

    16 bits for each character, the latest lowest: free of collisions for the basic plane.
    """
    key = (points & 0xFFFF).astype(np.uint64)
    for back in range(1, order):
        prev = np.full(len(points), _BLANK, np.uint64)
        if len(points) > back:
            same = own[back:] == own[:-back]
            prev[back:][same] = (points[:-back][same] & 0xFFFF).astype(np.uint64)
        key |= prev << np.uint64(16 * back)
    return key


@dataclass
class LanguageModel:
    """``keys[k]`` sorted, ``logs[k]`` one row for each key and column for each language, for orders 1 to n."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    floor: np.ndarray
    margin: float = 0.0

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean bits per character, texts by languages, and characters."""
        points, own = letters(texts)
        total = np.zeros((len(texts), len(self.languages)))
        if len(points) == 0:
            return total, np.zeros(len(texts), np.int64)
        scores = np.empty((len(points), len(self.languages)), np.float32)
        left = np.arange(len(points))
        full = gram_keys(points, own, len(self.keys))
        for order in range(len(self.keys), 0, -1):
            table = self.keys[order - 1]
            keys = full[left] & np.uint64((1 << (16 * order)) - 1)
            if len(table):
                at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                hit = table[at] == keys
                scores[left[hit]] = self.logs[order - 1][at[hit]]
                left = left[~hit]
            if not len(left):
                break
        scores[left] = self.floor
        length = np.bincount(own, minlength=len(texts))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(own, weights=scores[:, k], minlength=len(texts))
        return -total / np.maximum(length, 1)[:, None], length


@dataclass
class StoredModel:
    """``tables[k]`` has ``gram, logs`` of order k + 1; ``head`` are the most frequent keys of the highest order, sorted, and their logs."""

    languages: list[str]
    tables: list[DataFrame]
    head: tuple[np.ndarray, np.ndarray]
    floor: float
    margin: float = 0.0


def _count_partition(batches: Iterator[pd.DataFrame], order: int) -> Iterator[pd.DataFrame]:
    """Partial counts: one row for each language, n-gram of ``order`` characters and partition."""
    found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merge(parts):
        keys = np.concatenate([k for k, _ in parts])
        n = np.concatenate([c for _, c in parts])
        keys, at = np.unique(keys, return_inverse=True)
        return keys, np.bincount(at, weights=n).astype(np.int64)

    for part in slices(batches, chars=1_000_000):
        for lang, rows in part.groupby("lang"):
            points, own = letters(list(rows["text"]))
            if not len(points):
                continue
            keys, n = np.unique(gram_keys(points, own, order), return_counts=True)
            parts = found.setdefault(lang, [])
            parts.append((keys, n))
            if len(parts) > 8:
                found[lang] = [merge(parts)]
    for lang, parts in found.items():
        keys, n = merge(parts)
        yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n})


def _smooth(languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> LanguageModel:
    """Interpolated Kneser-Ney with one discount for each order, over the union of all languages' n-grams."""

    per_order: list[dict[str, tuple[np.ndarray, np.ndarray]]] = []
    now = counts
    for size in range(order, 0, -1):
        per_order.append(now)
        if size > 1:  # the lower order counts distinct left neighbours
            mask = np.uint64((1 << (16 * (size - 1))) - 1)
            now = {lang: np.unique(g & mask, return_counts=True) for lang, (g, _) in now.items()}
    per_order.reverse()
    all_keys, all_logs = [], []
    alphabet = max(1, len(np.unique(np.concatenate([per_order[0][x][0] for x in languages]))))
    lower_keys, lower_prob = np.zeros(0, np.uint64), None
    for size in range(1, order + 1):
        packed = np.unique(np.concatenate([per_order[size - 1][x][0] for x in languages]))
        probs = np.zeros((len(packed), len(languages)))
        for k, lang in enumerate(languages):
            grams, n = per_order[size - 1][lang]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            context, at = np.unique(grams >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(at, weights=n), np.bincount(at)
            wanted = packed >> np.uint64(16)
            here = np.searchsorted(context, wanted).clip(0, len(context) - 1)
            known = context[here] == wanted
            spot = np.searchsorted(grams, packed).clip(0, len(grams) - 1)
            own_n = np.where(grams[spot] == packed, n[spot], 0)
            if size == 1:
                below = np.full(len(packed), 1.0 / (alphabet + 1))
            else:
                mask = np.uint64((1 << (16 * (size - 1))) - 1)
                below = lower_prob[np.searchsorted(lower_keys, packed & mask).clip(0, len(lower_keys) - 1), k]
            share = np.maximum(own_n - discount, 0) / np.maximum(total[here], 1)
            rest = discount * kinds[here] / np.maximum(total[here], 1)
            probs[:, k] = np.where(known, share + rest * below, below)
        lower_keys, lower_prob = packed, probs
        all_keys.append(packed)
        all_logs.append(np.log2(np.maximum(probs, 1e-12)).astype(np.float32))
    floor = np.full(len(languages), np.log2(0.1 / (alphabet + 1)), np.float32)
    return LanguageModel(languages, all_keys, all_logs, floor)


def _smooth_stored(counts: DataFrame, languages: list[str], order: int, head: int) -> StoredModel:
    """What ``_smooth`` does, by joins of stored tables; ``counts`` is ``lang, gram, n``."""
    mask = lambda size: F.col("gram").bitwiseAND(F.lit((1 << (16 * size)) - 1))
    per_order = [counts]
    for size in range(order - 1, 0, -1):  # the lower order counts distinct left neighbours
        per_order.append(stored(per_order[-1].groupBy("lang", mask(size).alias("gram")).agg(F.count("*").alias("n")), "kn-counts"))
    per_order.reverse()
    names = range(len(languages))
    tables, lower, alphabet = [], None, 1
    for size in range(1, order + 1):
        rows = per_order[size - 1]
        few = {r["lang"]: (r["ones"], r["twos"]) for r in rows.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()}
        discounts = [ones / (ones + 2 * twos) if ones and twos else 0.5 for ones, twos in (few[x] for x in languages)]
        own = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).cast("double").alias(f"n{k}") for k, x in enumerate(languages)]
        wide = stored(rows.groupBy("gram").agg(*own).withColumn("context", F.shiftrightunsigned("gram", 16)), "kn-wide")
        totals = wide.groupBy("context").agg(*[F.sum(f"n{k}").alias(f"t{k}") for k in names], *[F.count_if(F.col(f"n{k}") > 0).alias(f"k{k}") for k in names])
        joined = wide.join(totals, "context")
        if size == 1:
            alphabet = wide.count()
            below = [F.lit(1.0 / (alphabet + 1)) for _ in names]
        else:
            joined = joined.withColumn("low", mask(size - 1)).join(lower.select(F.col("gram").alias("low"), F.col("probs").alias("below")), "low")
            below = [F.col("below")[k] for k in names]
        share = lambda k: F.greatest(F.col(f"n{k}") - discounts[k], F.lit(0.0)) / F.col(f"t{k}") + discounts[k] * F.col(f"k{k}") / F.col(f"t{k}") * below[k]  # noqa: B023, E731
        probs = F.array(*[F.when(F.col(f"t{k}") > 0, share(k)).otherwise(below[k]) for k in names])
        lower = stored(joined.select("gram", sum((F.col(f"n{k}") for k in names), F.lit(0.0)).alias("n"), probs.alias("probs")), "kn-probs")
        tables.append(lower.select("gram", "n", F.transform("probs", lambda p: F.log2(F.greatest(p, F.lit(1e-12))).cast("float")).alias("logs")))
    top = tables[-1].orderBy(F.desc("n"), "gram").limit(head).select("gram", "logs").toPandas()
    keys = top["gram"].to_numpy(np.int64).view(np.uint64)
    at = np.argsort(keys)
    logs = np.array(top["logs"].tolist(), np.float32).reshape(len(top), len(languages))[at]
    return StoredModel(languages, [t.select("gram", "logs") for t in tables], (keys[at], logs), float(np.float32(np.log2(0.1 / (alphabet + 1)))))


def train(rows: DataFrame, order: int = ORDER, max_grams: int = MAX_GRAMS, min_count: int = MIN_COUNT) -> LanguageModel | StoredModel | None:
    """Model of the labelled ``lang, text`` rows; null or empty languages and texts are left out. None without any letter."""
    labelled = rows.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    partial = labelled.mapInPandas(lambda b: _count_partition(b, order), "lang string, gram long, n long")
    summed = stored(partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "kn-counts")
    sizes = {r["lang"]: r["count"] for r in summed.groupBy("lang").count().collect()}
    if not sizes:
        return None
    if sum(sizes.values()) > max_grams:
        return _smooth_stored(summed, sorted(sizes), order, max(1, max_grams // len(sizes)))
    counts = {}
    for lang, part in summed.toPandas().groupby("lang"):
        grams = part["gram"].to_numpy(np.int64).view(np.uint64)
        at = np.argsort(grams)
        counts[lang] = (grams[at], part["n"].to_numpy(np.int64)[at])
    return _smooth(sorted(counts), counts, order)


def calibrate(model: LanguageModel | StoredModel | None, rows: DataFrame, precision: float = PRECISION) -> LanguageModel | StoredModel | None:
    """Sets the smallest entropy margin from which on at least ``precision`` of all training rows are right; equal margins count together."""
    if model is None or len(model.languages) < 2:
        return model
    labelled = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    # The language rides along in the id, so one pass gives both.
    tagged = identify(labelled.select(F.col("lang").alias("doc_id"), "text"), model)
    found = tagged.filter("lang_pred != 'und'").groupBy("margin").agg(F.count("*").alias("n"), F.count_if(F.col("lang_pred") == F.col("doc_id")).alias("right"))
    margins = stored(found, "kn-margins")
    # Margins are summed downwards within cells, from what lies in the cells above.
    edges = sorted(set(margins.approxQuantile("margin", [k / CELLS for k in range(1, CELLS)], 0.25 / CELLS)))
    cell = F.size(F.filter(F.array(*map(F.lit, edges)), lambda x: x <= F.col("margin"))) if edges else F.lit(0)
    celled = margins.withColumn("cell", cell)
    above, sums = [], (0, 0)
    for r in celled.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("right").alias("right")).orderBy(F.desc("cell")).collect():  # at most CELLS rows
        above.append((r["cell"], *sums))
        sums = sums[0] + r["n"], sums[1] + r["right"]
    before = F.broadcast(rows.sparkSession.createDataFrame(above, "cell int, above_n long, above_right long"))
    down = Window.partitionBy("cell").orderBy(F.desc("margin"))
    share = (F.col("above_right") + F.sum("right").over(down)) / (F.col("above_n") + F.sum("n").over(down))
    least = celled.join(before, "cell").withColumn("share", share).filter(F.col("share") >= precision).agg(F.min("margin")).first()[0]
    model.margin = float("inf") if least is None else float(least)
    return model


def _verdict(ids: np.ndarray, entropy: np.ndarray, length: np.ndarray, languages: list[str], least: float) -> pd.DataFrame:
    n = len(ids)
    best = entropy.argmin(1)
    two = np.sort(entropy, axis=1)
    scaled = -(entropy - two[:, :1]) * np.sqrt(np.minimum(length, 400))[:, None] * np.log(2)
    score = 1 / np.exp(np.maximum(scaled, -700)).sum(1)
    margin = (two[:, 1] - two[:, 0]) * np.sqrt(np.minimum(length, 400)) if two.shape[1] > 1 else np.full(n, np.inf)
    some = length > 0
    return pd.DataFrame({
        "doc_id": ids,
        "lang_pred": np.where(some, np.array(languages, dtype=object)[best], "und"),
        "score": np.where(some, score, 0.0), "cross_entropy": np.where(some, two[:, 0], np.nan),
        "margin": np.where(some, margin, np.nan), "accepted": some & (margin >= least),
    })


def _stored_sums(docs: DataFrame, model: StoredModel) -> DataFrame:
    """``doc_id, length, sums`` of every row: log probabilities summed for each language, with n-grams outside the head joined."""
    order, size = len(model.tables), len(model.languages)
    shared = docs.sparkSession.sparkContext.broadcast(model.head)

    def work(part: pd.DataFrame) -> pd.DataFrame:
        table, logs = shared.value
        points, own = letters(list(part["text"]))
        keys = gram_keys(points, own, order)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        hit = table[at] == keys
        sums = np.stack([np.bincount(own[hit], weights=logs[at[hit], k], minlength=len(part)) for k in range(size)], 1)
        ends = np.searchsorted(own[~hit], np.arange(len(part) + 1))
        rest = [np.unique(keys[~hit][a:b].view(np.int64), return_counts=True) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pd.DataFrame({
            "row": [uuid.uuid4().hex for _ in range(len(part))], "doc_id": part["doc_id"].to_numpy(), "length": np.bincount(own, minlength=len(part)),
            "sums": sums.tolist(), "gram": [g.tolist() for g, _ in rest], "times": [n.tolist() for _, n in rest],
        })

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row string, doc_id {kind}, length long, sums array<double>, gram array<long>, times array<long>"
    rows = stored(map_texts(docs.select("doc_id", "text"), work, schema), "kn-rows")
    tail = rows.select("row", F.explode(F.arrays_zip("gram", "times")).alias("g")).select("row", "g.gram", "g.times")
    logs, known = tail.select("gram").distinct(), []
    for k in range(order, 0, -1):
        key = F.col("gram") if k == order else F.col("gram").bitwiseAND(F.lit((1 << (16 * k)) - 1))
        logs = logs.withColumn("key", key).join(model.tables[k - 1].select(F.col("gram").alias("key"), F.col("logs").alias(f"logs{k}")), "key", "left").drop("key")
        known.append(F.col(f"logs{k}"))
    found = logs.select("gram", F.coalesce(*known, F.array_repeat(F.lit(model.floor).cast("float"), size)).alias("logs"))
    added = tail.join(found, "gram").groupBy("row").agg(F.array(*[F.sum(F.col("times") * F.col("logs")[k].cast("double")) for k in range(size)]).alias("added"))
    total = F.when(F.col("added").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "added", lambda a, b: a + b))
    return rows.join(added, "row", "left").select("doc_id", "length", total.alias("sums"))


def identify(docs: DataFrame, model: LanguageModel | StoredModel | None) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, margin, accepted`` for every text.

    ``score`` is the share of the best language's likelihood after tempering by the text's length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, cross_entropy double, margin double, accepted boolean"
    if isinstance(model, StoredModel):
        languages, least = model.languages, model.margin

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                if len(part):
                    length = part["length"].to_numpy(np.int64)
                    yield _verdict(part["doc_id"].to_numpy(), -np.stack(part["sums"].to_list()) / np.maximum(length, 1)[:, None], length, languages, least)

        return _stored_sums(docs, model).mapInPandas(judge, schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pd.DataFrame) -> pd.DataFrame:
        own = shared.value
        n = len(part)
        if own is None:
            return pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "lang_pred": ["und"] * n, "score": 0.0, "cross_entropy": np.nan, "margin": np.nan, "accepted": False})
        return _verdict(part["doc_id"].to_numpy(), *own.cross_entropy(list(part["text"])), own.languages, own.margin)

    return map_texts(docs.select("doc_id", "text"), work, schema)
