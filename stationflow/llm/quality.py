"""Quality rules: a decision list, learned by sequential covering from labelled statistics of whole texts.

Rules are conjunctions of thresholds on the statistics. Each is grown condition by condition for information gain on two thirds of the
examples, then pruned on the last third, and accepted only if it is precise there; then what it covers is taken away, and the next is grown.
The result is an ordered list, applied as one chained Spark conditional expression: the first rule that holds rejects the document,
no rule keeps it.

The statistics cover all texts, whole. The classifier is fitted on at most `sample` labelled documents, chosen by a hash of the id.

Defined results: null text counts as empty: all its counts are 0 and its ratios are null, for which no condition holds. Labels that
are null or not 0 or 1 are ignored; of several labels of an id the majority counts (ties: good). No labels, or one class alone: no rule, all is kept.
Repeated rows each give a row. An empty table gives no rows. Other columns are passed on by keep_good() and ignored by judge().
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Words, bounded_batches, chunks, cut, gram_hashes, mix

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_marks")
#: Ratios that rules use, by numerator and denominator. None of them drifts with a clean text's length.
RATIOS = {"symbols_per_word": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"), "chars_per_word": ("word_chars", "n_words"), "upper_share": ("n_upper", "n_letters"), "digits_per_word": ("n_digits", "n_words"), "marks_per_word": ("n_marks", "n_words")}


def flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


SYMBOL, UPPER, DIGIT, MARK = flags(b"#*$%&|<>"), flags(bytes(range(65, 91))), flags(b"0123456789"), flags(b"!?")
LETTER = flags(bytes([*range(65, 91), *range(97, 123)]))
CODE_POINT = np.arange(256) & 0xC0 != 0x80


def text_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offs) - 1

    def within(mask: np.ndarray, at: np.ndarray = offs) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[at[1:]] - sums[at[:-1]]

    words = Words(buf, offs)
    h, doc = words.hashes(), words.doc()
    out = {"n_words": words.counts, "word_chars": within(CODE_POINT[buf] & ~SPACE[buf])}
    for name, kind in (("n_symbols", SYMBOL), ("n_upper", UPPER), ("n_letters", LETTER), ("n_digits", DIGIT), ("n_marks", MARK)):
        out[name] = within(kind[buf])
    lines, dups = np.zeros(n, np.int64), np.zeros(n, np.int64)
    data = buf.tobytes()
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
        own = [x for x in data[a:b].split(b"\n") if x.strip()]
        lines[i], dups[i] = len(own), len(own) - len(set(own))
    of = mix(np.arange(1, n + 1, dtype=np.uint64))
    grams = gram_hashes(h, 3)
    valid = doc[2:] == doc[:-2] if len(doc) > 2 else np.zeros(0, bool)
    start = np.flatnonzero(valid)
    _, back, count = np.unique(grams[start] ^ of[doc[start]], return_inverse=True, return_counts=True)
    again = np.zeros(len(h), bool)
    for i in range(3):
        again[start[count[back] > 1] + i] = True
    return out | {"n_dup_lines": dups, "n_lines": lines, "n_repeat_words": within(again, words.first)}


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (or the columns of `keep`) and the counts of every text."""
    bounded_batches(docs.sparkSession)
    keep = keep or (id,)
    own = docs.select(*keep, F.col(text).cast("string").alias("__x"))

    def run(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            got = text_counts(buf, offs)
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *(pa.array(got[c].astype(np.int64)) for c in COUNTS)], names=[*keep, *COUNTS])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    return own.mapInArrow(run, kinds + "".join(f", {c} long" for c in COUNTS))


@dataclass(frozen=True)
class Rule:
    """Rejects where every condition (statistic, above?, threshold) holds."""

    conditions: tuple[tuple[str, bool, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, above, t in self.conditions:
            out &= x[name] > t if above else x[name] < t
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, t in self.conditions:
            value = ratio(name)
            out = out & (value > t if above else value < t)
        return F.coalesce(out, F.lit(False))

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if above else '<'} {t:.6g}" for n, above, t in self.conditions)


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))


def grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int, cuts: int) -> Rule:
    """Adds the condition of greatest gain (positives kept times the growth of their log share) until none gains or all are positive."""
    rule, held = Rule(()), np.ones(len(bad), bool)
    while len(rule.conditions) < most and not bad[held].all():
        p0, n0 = bad[held].sum(), held.sum()
        best = (1e-9, None)
        for name, values in x.items():
            v, b = values[held], bad[held]
            ok = ~np.isnan(v)
            order = np.argsort(v[ok], kind="stable")
            v, b = v[ok][order], b[ok][order]
            edge = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(edge):
                continue
            edge = np.unique(edge[np.linspace(0, len(edge) - 1, min(cuts, len(edge))).astype(int)])
            low = np.cumsum(b)[edge - 1]
            for above, p, n in ((False, low, edge), (True, b.sum() - low, len(v) - edge)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - np.log2(p0 / n0)), -1)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], (name, above, float((v[edge[i] - 1] + v[edge[i]]) / 2)))
        if best[1] is None:
            break
        rule = Rule((*rule.conditions, best[1]))
        held = rule.covers(x)
    return rule


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest head of the conditions with the best (bad - good) share of what it covers."""
    def worth(r: Rule) -> float:
        held = r.covers(x)
        return float(bad[held].mean()) if held.any() else 0.0

    heads = [Rule(rule.conditions[:i]) for i in range(1, len(rule.conditions) + 1)]
    return max(heads, key=lambda r: (round(worth(r), 4), -len(r.conditions)))


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.97, most_rules: int = 24, most_conditions: int = 4, cuts: int = 64, least: int = 4, seed: int = 3) -> list[Rule]:
    rules: list[Rule] = []
    order = np.random.Generator(np.random.PCG64(seed)).permutation(len(bad))
    left = np.ones(len(bad), bool)
    side = np.zeros(len(bad), bool)
    side[order[: 2 * len(bad) // 3]] = True
    part = lambda m: {k: v[m] for k, v in x.items()}
    while len(rules) < most_rules and bad[left & side].sum() >= least:
        a, b = left & side, left & ~side
        rule = prune(grow(part(a), bad[a], most_conditions, cuts), part(b), bad[b]) if b.any() else grow(part(a), bad[a], most_conditions, cuts)
        held = rule.covers(x)
        own = held & left
        if not rule.conditions or own.sum() < least or bad[own].mean() < precision or bad[held].mean() < precision:
            break
        rules.append(rule)
        left &= ~held
    return rules


def chosen_labels(labels: DataFrame, id: str = "doc_id", sample: int = 20_000) -> DataFrame:
    """__l, bad of at most `sample` labelled ids."""
    labels = labels.where("quality in (0, 1)").groupBy(F.col(id).alias("__l")).agg((F.avg("quality") < 0.5).alias("bad"))
    return labels.where("__l is not null").orderBy(F.xxhash64("__l"), "__l").limit(sample)


def fit(stats: DataFrame, chosen: DataFrame, id: str = "doc_id", precision: float = 0.97) -> list[Rule]:
    """Rules from the statistics of the chosen documents."""
    rows = stats.join(chosen, F.col(id) == F.col("__l")).dropDuplicates([id]).select("__l", "bad", *(ratio(r).alias(r) for r in RATIOS)).orderBy("__l").toPandas()
    bad = rows["bad"].to_numpy(bool)
    if not bad.any() or bad.all():
        return []
    return learn({r: rows[r].to_numpy(float) for r in RATIOS}, bad, precision)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, or null: one ordered conditional expression."""
    out = None
    for i, rule in enumerate(rules):
        out = F.when(rule.column(), F.lit(i)) if out is None else out.when(rule.column(), F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample: int = 20_000) -> DataFrame:
    """The statistics of every document and `rule`, the number of the rule that rejects it."""
    stats = cut(statistics(docs, id, text))  # only counts are kept and shuffled, never texts
    return stats.withColumn("rule", verdict(fit(stats, chosen_labels(labels, id, sample), id)))


def keep_good(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample: int = 20_000) -> DataFrame:
    """docs without those that a learned rule rejects."""
    chosen = chosen_labels(labels, id, sample)
    clash = {c: f"__own_{i}" for i, c in enumerate(docs.columns)}
    own = docs.toDF(*clash.values()).withColumn("__same", F.col(clash[text]))
    labelled = own.join(F.broadcast(chosen.select("__l")), own[clash[id]] == F.col("__l"), "left_semi")  # at most `sample` ids
    rules = fit(statistics(labelled, clash[id], "__same"), chosen, clash[id])
    held = statistics(own, clash[id], "__same", keep=tuple(clash.values()))
    return held.where(verdict(rules).isNull()).select(*(F.col(v).alias(k) for k, v in clash.items()))
