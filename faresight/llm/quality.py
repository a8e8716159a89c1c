"""Quality rules: learned decision lists over text statistics.

Statistics of every whole text are DataFrame expressions.  From labelled rows,
sequential covering learns an ordered list of rules, each a conjunction of
thresholds on the statistics: a rule grows by the condition of highest
information gain until it holds no good row, is pruned on rows it did not grow
on, and is kept if it stays precise there; rows it covers are then set aside.
The list becomes one Spark conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faresight.llm.common import SPACES, materialize, words

#: Characters counted as symbols, and the base rule's limits (fixed by the contract).
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
#: Labelled rows that the list is fitted on at most (by smallest id hash); everything else covers all rows.
FIT_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_COVERED = 3
MIN_PRECISION = 0.95
SEED = 4

#: Learned-on ratios by name, as SQL over the statistics.
FEATURES = {
    "mean_word_chars": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct_words / n_words",
    "words": "double(n_words)",
}


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: Sequence[str] = ()) -> DataFrame:
    """``id_col``, the columns ``carry`` and the statistics of each whole text, all long.

    ``n_repeat_words`` counts the words inside 5-word windows that occur twice
    or more in the text.  Windows are sorted by hash and position; neighbours
    of one hash are then compared word by word, so the cost is n log n and a
    long repetitive text never meets a lookup per pair.
    """
    k = REPEAT_WINDOW
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    window_hash = ", ".join(f"_h[i + {j}]" for j in range(k))
    same = f"({{a}}.hash = {{b}}.hash AND slice(_h, {{a}}.at + 1, {k}) = slice(_h, {{b}}.at + 1, {k}))"
    twin = (f"(i > 0 AND {same.format(a='x', b='_keys[i - 1]')}) OR "
            f"(i < size(_keys) - 1 AND {same.format(a='x', b='_keys[i + 1]')})")
    own = [id_col, *carry]
    return (docs.select(*own, text.alias("_text"), words(text).alias("_words"), lines.alias("_lines"))
            .select(*own, F.size("_words").cast("long").alias("n_words"),
                    F.char_length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
                    (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    F.size("_lines").cast("long").alias("n_lines"),
                    (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                    F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
            .withColumn("n_distinct_words", F.size(F.array_distinct("_h")).cast("long"))
            .withColumn("_keys", F.expr(
                f"IF(size(_h) > {k}, sort_array(transform(sequence(0, size(_h) - {k}), "
                f"i -> named_struct('hash', xxhash64({window_hash}), 'at', i))), "
                "cast(array() as array<struct<hash: bigint, at: int>>))"))
            .withColumn("_at", F.expr(f"sort_array(transform(filter(_keys, (x, i) -> {twin}), x -> bigint(x.at)))"))
            .withColumn("n_repeat_words", F.expr(
                f"aggregate(_at, named_struct('last', bigint(-{k}), 'n', 0L), (s, x) -> "
                f"named_struct('last', x, 'n', s.n + least({k}L, x - s.last)), s -> s.n)"))
            .select(*own, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                    "n_distinct_words"))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


@dataclass(frozen=True)
class Condition:
    """``feature`` above (or at most) ``limit``."""

    feature: str
    above: bool
    limit: float

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.limit) == self.above

    def sql(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.limit!r}D"


def _grow(rows: list[dict], names: Sequence[str]) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        bad = sum(r["bad"] for r in rows)
        if bad == 0 or bad == len(rows):
            break
        before = math.log2(bad / len(rows))
        best, gain = None, 1e-9
        for f in names:
            ordered = sorted(rows, key=lambda r: r[f])
            below = 0
            for i, (r, s) in enumerate(zip(ordered, ordered[1:], strict=False), 1):
                below += r["bad"]
                if r[f] == s[f]:
                    continue
                for above, p, n in ((True, bad - below, len(rows) - i), (False, below, i)):
                    if p and (g := p * (math.log2(p / n) - before)) > gain:
                        best, gain = Condition(f, above, (r[f] + s[f]) / 2), g
        if best is None:
            break
        rule.append(best)
        rows = [r for r in rows if best.holds(r)]
    return rule


def _covered(rule: Sequence[Condition], rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _worth(rule: Sequence[Condition], rows: list[dict]) -> float:
    got = _covered(rule, rows)
    return (2 * sum(r["bad"] for r in got) - len(got)) / len(got) if got else -1.0


def learn_rules(rows: list[dict], names: Sequence[str] = tuple(FEATURES)) -> list[list[Condition]]:
    """Ordered rules for ``bad`` rows; ``rows`` hold the features, ``bad`` and ``prune`` (0/1)."""
    rules: list[list[Condition]] = []
    left = list(rows)
    while len(rules) < MAX_RULES:
        grow, prune = [r for r in left if not r["prune"]], [r for r in left if r["prune"]]
        rule = _grow(grow, names)
        while len(rule) > 1 and _worth(rule[:-1], prune) >= _worth(rule, prune):
            rule = rule[:-1]
        got = _covered(rule, left) if rule else []
        seen = _covered(rule, prune) if rule else []
        if len(got) < MIN_COVERED or sum(r["bad"] for r in got) < MIN_PRECISION * len(got) or \
                sum(r["bad"] for r in seen) < MIN_PRECISION * len(seen):
            break
        rules.append(rule)
        left = [r for r in left if not all(c.holds(r) for c in rule)]
    return rules


def decision_list(rules: Sequence[Sequence[Condition]]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        cond = F.expr(" AND ".join(f"({c.sql()})" for c in rule))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def fit_rules(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
              fit_rows: int = FIT_ROWS) -> list[list[Condition]]:
    """Rules learned from the labelled rows (label 0: bad) that pass the base rule."""
    labelled = (labels.select(F.col(id_col), F.col(label_col).alias("_label"))
                .filter(F.col("_label").isNotNull() & F.col(id_col).isNotNull())
                .join(stats.filter(~base_failed()), id_col))
    key = F.xxhash64(F.col(id_col), F.lit(SEED))
    labelled = materialize(labelled, "quality-labelled")
    # about fit_rows of all by hash, so that tasks send no more than the sample; the limit only trims chance
    share = min(1.0, 1.1 * fit_rows / max(1, labelled.count()))
    labelled = labelled.filter(F.pmod(key, F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    sample = (labelled.select(key.alias("_key"), (F.col("_label") == 0).cast("int").alias("bad"),
                              (F.pmod(key, F.lit(3)) == 0).cast("int").alias("prune"),
                              *[F.expr(e).alias(n) for n, e in FEATURES.items()])
              .orderBy("_key", "bad", *FEATURES).limit(fit_rows))
    return learn_rules([r.asDict() for r in sample.collect()])


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", fit_rows: int = FIT_ROWS, carry: Sequence[str] = ()) -> DataFrame:
    """Statistics and verdict for every row of ``docs``.

    Returns ``id_col``, the columns named in ``carry``, the statistics, ``base_failed``, ``rule`` (number of the
    rule that rejects the row, 0 for none) and ``kept``.

    Null or blank text has no words and fails the base rule.  Rows with equal
    ids each get their own verdict.  Without labels of both kinds no rule is
    learned and the base rule alone decides.  Empty tables give empty results;
    other columns are not read.
    """
    stats = materialize(text_statistics(docs, id_col, text_col, carry), "quality")
    rules = fit_rules(stats, labels, id_col, label_col, fit_rows)
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("rule", F.when(F.col("base_failed"), F.lit(0)).otherwise(decision_list(rules)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
