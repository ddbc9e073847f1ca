"""Quality rules as a learned decision list, in DataFrame operations only.

Statistics of each text are array expressions over its words. From labelled rows,
sequential covering grows one conjunction of thresholds after another: each step takes
the condition with the highest gain among all features and thresholds, counted by one
small aggregation; conditions that do not help on rows held back are pruned again.
The ordered rules become one conditional expression that every row is judged by.
"""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import functions as F

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read
from gradeloom.sources.staging import stage

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit; none of them touches the rows that are judged.

    ``sample_rows`` bounds the labelled rows fitted on: those whose key has the
    smallest hash. ``thresholds`` is the number of cut points per feature.
    """

    sample_rows: int = 20_000
    thresholds: int = 40
    max_rules: int = 12
    max_conditions: int = 4
    min_precision: float = 0.9
    min_rows: int = 5


def _let(value, body):
    """``body(value)`` with the value worked out once.

    A plain column would be put into the lambdas that use it, and be worked out again
    for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text, characters):
    return F.translate(text, characters, "")


def _repeat_words(words, n):
    """Words that lie in a five-word window found twice or more."""

    def covered(starts):
        gap = lambda start, i: F.least(
            F.lit(5), F.coalesce(F.get(starts, i + 1) - start, F.lit(5))
        )
        return F.aggregate(F.transform(starts, gap), F.lit(0), lambda total, x: total + x)

    def repeated(placed):
        same = lambda i, j: F.get(placed, i)["w"] == F.coalesce(F.get(placed, j)["w"], F.lit(None))
        beside = lambda p, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(
            same(i, i + 1), F.lit(False)
        )
        starts = F.transform(F.filter(placed, beside), lambda p: p["i"])
        return _let(F.sort_array(starts), covered)

    def count(windows):
        placed = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            _let(F.sort_array(placed), repeated)
        )

    windows = F.transform(F.sequence(F.lit(1), n - 4), lambda i: F.xxhash64(F.slice(words, i, 5)))
    return F.when(n < 6, 0).otherwise(_let(windows, count))


def add_statistics(df, text="text", name="_statistics"):
    """Add a struct of counts of each text; a null text counts as empty.

    Words are runs of characters other than ASCII white space, and all counts are over
    the whole text. The cost is that of sorting the words of one text.
    """

    def of_lines(lines):
        return F.struct(
            F.size(lines).alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        )

    def of_words(words):
        n = F.size(words)
        return F.struct(
            n.alias("n_words"),
            _repeat_words(words, n).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).alias("n_distinct"),
        )

    def of_text(t):
        words = F.filter(F.split(F.translate(t, SPACES, " " * 6), " "), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda line: _without(line, SPACES) != "")
        size = F.length(t)
        return F.struct(
            _let(words, of_words).alias("words"),
            _let(lines, of_lines).alias("lines"),
            F.length(_without(t, SPACES)).alias("word_chars"),
            (size - F.length(_without(t, SYMBOLS))).alias("n_symbols"),
            (size - F.length(_without(t, "".join(map(chr, range(65, 91)))))).alias("n_upper"),
            (size - F.length(_without(t, "!?"))).alias("n_marks"),
            (size - F.length(_without(t, "0123456789"))).alias("n_digits"),
            (size - F.length(_without(t, ".,;:"))).alias("n_stops"),
        )

    # A one-row generator: a plain column would be put into, and worked out by, each
    # of the many expressions that use it.
    once = F.explode_outer(F.array(_let(F.coalesce(F.col(text), F.lit("")), of_text)))
    return df.drop(name).select("*", once.alias(name))


def features(name="_statistics"):
    """Doubles that rules compare, by name; a share of an empty text is 0."""
    of = lambda path: F.col(f"{name}.{path}").cast("double")
    words, chars = F.greatest(of("words.n_words"), F.lit(1.0)), F.greatest(of("word_chars"), F.lit(1.0))
    return {
        "n_words": of("words.n_words"),
        "chars_per_word": of("word_chars") / words,
        "symbols_per_word": of("n_symbols") / words,
        "marks_per_word": of("n_marks") / words,
        "stops_per_word": of("n_stops") / words,
        "upper_share": of("n_upper") / chars,
        "digit_share": of("n_digits") / chars,
        "distinct_share": of("words.n_distinct") / words,
        "repeat_share": of("words.n_repeat_words") / words,
        "dup_line_share": of("lines.n_dup_lines") / F.greatest(of("lines.n_lines"), F.lit(1.0)),
        "words_per_line": of("words.n_words") / F.greatest(of("lines.n_lines"), F.lit(1.0)),
    }


def base_failed(name="_statistics"):
    n = F.col(f"{name}.words.n_words")
    return (n < 10) | (100 * F.col(f"{name}.words.n_repeat_words") > 20 * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    cut: int  # its place among the feature's cut points

    def column(self, values):
        value = values[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def on_bins(self, names):
        bin_of = F.get("bins", names.index(self.feature))
        return bin_of > self.cut if self.above else bin_of <= self.cut


def _counts(rows):
    """{(feature place, bin): [negatives, positives]} of binned rows."""
    counted = rows.select("bad", "rows", F.posexplode("bins").alias("feature", "bin"))
    found = {}
    for r in counted.groupBy("feature", "bin", "bad").agg(F.sum("rows").alias("n")).collect():
        found.setdefault((r.feature, r.bin), [0, 0])[r.bad] += r.n
    return found


def _best_condition(counts, names, cuts, taken, settings):
    """The condition with the highest gain and the good rows it still covers."""
    good, bad = (sum(v[i] for (f, _), v in counts.items() if f == 0) for i in (0, 1))
    if not bad:
        return None
    information = lambda g, b: math.log2(b / (g + b))
    best, found = 0.0, None
    for place, name in enumerate(names):
        below_good = below_bad = 0
        for cut, threshold in enumerate(cuts[name]):
            g, b = counts.get((place, cut), (0, 0))
            below_good, below_bad = below_good + g, below_bad + b
            for above, g, b in ((False, below_good, below_bad), (True, good - below_good, bad - below_bad)):
                if b < settings.min_rows or g + b == good + bad or (name, above) in taken:
                    continue
                gain = b * (information(g, b) - information(good, bad))
                if gain > best * (1 + 1e-9):
                    best, found = gain, (Condition(name, above, threshold, cut), g)
    return found


def _holds(rule, names):
    return reduce(lambda a, b: a & b, [c.on_bins(names) for c in rule], F.lit(True))


def _tally(rows, rules, names):
    """[(negatives, positives)] that each rule covers, in one aggregation."""
    sums = [
        F.coalesce(F.sum(F.when(_holds(rule, names) & (F.col("bad") == bad), F.col("rows"))), F.lit(0))
        for rule in rules
        for bad in (0, 1)
    ]
    row = rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(rules))]


def _grow(rows, names, cuts, settings):
    rule, good = [], None
    while good != 0 and len(rule) < settings.max_conditions:
        counts = _counts(rows.where(_holds(rule, names)))
        taken = {(c.feature, c.above) for c in rule}
        found = _best_condition(counts, names, cuts, taken, settings)
        if found is None:
            break
        condition, good = found
        rule.append(condition)
    return rule


def _prune(rows, rule, names):
    """The prefix of the rule that is worth most on rows it was not grown on."""
    prefixes = [rule[: i + 1] for i in range(len(rule))]
    worth = lambda g, b: (b + 1) / (g + b + 2)
    tallies = _tally(rows, prefixes, names)
    best = max(range(len(prefixes)), key=lambda i: (worth(*tallies[i]), -i))
    return prefixes[best]


def fit(labelled, values, label="quality", key="doc_id", settings=Settings()):
    """Ordered rules that reject; ``labelled`` has the statistics and a 0/1 label.

    Rows without a label are left out. One third of the rows, by hash of the key, is
    held back for pruning. Without bad rows there are no rules and everything stays.
    """
    names = list(values)
    rows = labelled.where(F.col(label).isin(0, 1) & ~base_failed()).select(
        (F.col(label) == 0).cast("int").alias("bad"),
        (F.pmod(F.xxhash64(F.lit("held"), F.col(key)), F.lit(3)) == 0).alias("held"),
        *[values[n].alias(f"f{i}") for i, n in enumerate(names)],
    )
    rows = stage(rows, "labelled")
    steps = [(i + 0.5) / settings.thresholds for i in range(settings.thresholds)]
    # Cut points of good and bad rows apart: the few bad ones would leave few cuts.
    points = rows.groupBy("bad").agg(
        *[F.percentile_approx(f"f{i}", steps, 10_000).alias(f"f{i}") for i in range(len(names))]
    ).collect()
    cuts = {n: sorted({x for r in points for x in r[f"f{i}"]}) for i, n in enumerate(names)}

    def bin_of(name, value):
        return F.size(F.filter(F.lit(cuts[name]), lambda cut: cut < value))

    bins = [bin_of(n, F.col(f"f{i}")) for i, n in enumerate(names)]
    # At most ``sample_rows`` rows of small integers: one task reads them at once.
    binned = rows.select("bad", "held", F.array(*bins).alias("bins"), F.lit(1).alias("rows"))
    binned = stage(binned.coalesce(1), "binned")
    rules = []
    while len(rules) < settings.max_rules:
        left = binned
        for rule in rules:
            left = left.where(~_holds(rule, names))
        rule = _grow(left.where("not held"), names, cuts, settings)
        if not rule:
            break
        rule = _prune(left.where("held"), rule, names)
        good, bad = _tally(left, [rule], names)[0]
        if bad < settings.min_rows or bad < settings.min_precision * (good + bad):
            break
        rules.append(rule)
    return rules


def verdict(rules, values):
    """True where no rule rejects, as one ordered conditional."""
    kept = None
    for rule in rules:
        holds = reduce(lambda a, b: a & b, [c.column(values) for c in rule])
        kept = F.when(holds, False) if kept is None else kept.when(holds, False)
    return F.lit(True) if kept is None else kept.otherwise(True)


def labelled_sample(df, labels, key, label, settings):
    """Statistics of at most ``sample_rows`` labelled rows of ``df``.

    The sample's keys are bounded and so may be broadcast; the texts stay in place.
    Labels of rows that ``df`` lacks take up room in the sample, no more.
    """
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .select(F.col(key).alias("_key"), F.col(label).alias("_label"))
        .orderBy(F.xxhash64("_key"), "_key", "_label")
        .limit(settings.sample_rows)
        .groupBy("_key")
        .agg(F.min("_label").alias("_label"))
    )
    texts = df.select(F.col(key).alias("_key"), F.col("text").alias("_text"))
    joined = texts.join(F.broadcast(chosen), "_key")
    return add_statistics(joined, "_text").drop("_text")


def judge(df, labels, key="doc_id", label="quality", settings=Settings()):
    """Add the statistics, ``base_failed`` and ``kept`` to each row of ``df``.

    ``df`` has ``key`` and ``text``. Rules come from the labelled rows; every row is
    judged by its own text alone. A null or empty text has no words and fails the base
    rule. Rows with a null or repeated key are judged like any other. Columns named
    like an added one are replaced.
    """
    values = features()
    sample = labelled_sample(df, labels, key, label, settings)
    rules = fit(sample, values, "_label", "_key", settings)
    judged = add_statistics(df).withColumns(
        {
            "n_words": F.col("_statistics.words.n_words").cast("long"),
            "word_chars": F.col("_statistics.word_chars").cast("long"),
            "n_symbols": F.col("_statistics.n_symbols").cast("long"),
            "n_dup_lines": F.col("_statistics.lines.n_dup_lines").cast("long"),
            "n_repeat_words": F.col("_statistics.words.n_repeat_words").cast("long"),
            "base_failed": base_failed(),
            "kept": ~base_failed() & verdict(rules, values),
        }
    )
    return judged.drop("_statistics")


@query("op3_decision_list")
def op3_decision_list(spark, sf_dir):
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(documents, read(spark, sf_dir, "labels")).drop("text")
