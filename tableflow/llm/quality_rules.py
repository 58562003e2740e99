"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at some figures of a text and votes good (1), bad (-1) or abstains (0). Documents
with the same votes are counted together, and expectation-maximisation on these counts (at most
3^rules rows, however many documents) estimates the share of good documents and how often each rule
is right on good and on bad ones. A document is kept if the probability that it is good, given its votes, is at least one
half and it does not fail the base limits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.session import materialise

ROUNDS = 25
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# White space, and frequent small words of the four languages.
SPACE = " \t\n\x0b\x0c\r"
SPACES = "[ \\t\\n\\x0B\\f\\r]+"
SMALL_WORDS = (
    "the of and to in is that for with be by it are was this from as on or an "
    "der die das und ist nicht ein eine mit von zu für den dem des "
    "le la les des et un une du de que qui dans pour par est pas sur "
    "el los las una que en por con para del se es como más").split()

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FIGURES = {
    "n_words": "cast(size(words) as long)",
    "word_chars": "cast(char_length(array_join(words, '')) as long)",
    "n_symbols": "cast(char_length(regexp_replace(body, '[^#*$%&|<>]+', '')) as long)",
    "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as long)",
    "n_lines": "cast(size(lines) as long)",
    "n_upper": "cast(char_length(regexp_replace(body, '[^A-Z]+', '')) as long)",
}


def count_figures(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """The figures of every whole text; a null text has no words and no lines."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.select(*keep, body.alias("body")).select("*", F.btrim("body", F.lit(SPACE)).alias("core"))
    split = split.select(
        "*", F.when(F.col("core") == "", F.array().cast("array<string>"))
        .otherwise(F.split("core", SPACES)).alias("words"),
        F.filter(F.split("body", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "").alias("lines"))
    names = [c for c in split.columns if c not in ("body", "core", "words", "lines")]
    figures = [F.expr(how).alias(name) for name, how in _FIGURES.items()]
    small = F.array(*[F.lit(w) for w in dict.fromkeys(SMALL_WORDS)])
    hashes = """CASE WHEN size(words) < 3 THEN array() ELSE
        sort_array(transform(sequence(0, size(words) - 3), i ->
            named_struct('h', xxhash64(words[i], words[i + 1], words[i + 2]), 'at', i))) END"""
    seen = split.select(*names, *figures,
                        F.size(F.array_intersect(small, F.array_distinct("words"))).alias("n_small"),
                        F.expr(hashes).alias("windows"))
    # Windows in order of their hash: those equal to a neighbour occur at least twice.
    twice = F.expr("""sort_array(transform(filter(windows, (x, i) ->
        (i > 0 AND windows[greatest(i - 1, 0)].h = x.h)
        OR (i < size(windows) - 1 AND windows[least(i + 1, size(windows) - 1)].h = x.h)), x -> x.at))""")
    covered = F.expr("""cast(aggregate(twice, named_struct('last', -3, 'n', 0), (a, x) ->
        named_struct('last', x, 'n', a.n + least(3, x - a.last)), a -> a.n) as long)""")
    rest = [c for c in seen.columns if c != "windows"]
    return seen.select(*rest, twice.alias("twice")).select(*rest, covered.alias("n_repeat_words"))


def rule_votes() -> dict[str, Column]:
    """Votes from the figures. Texts without words get a bad vote for length, else no votes."""
    n = F.col("n_words")

    def vote(bad: Column, good: Column) -> Column:
        return F.when(n == 0, 0).when(bad, -1).when(good, 1).otherwise(0).cast("int")

    per_word = F.col("word_chars") / n
    return {
        "length": F.when(n < MIN_WORDS, -1).otherwise(0).cast("int"),
        "word_length": vote((per_word < 2) | (per_word > 9), per_word.between(3, 7.5)),
        "symbols": vote(F.col("n_symbols") * 10 > n, F.col("n_symbols") * 30 <= n),
        "lines": vote(F.col("n_dup_lines") * 10 > F.col("n_lines") * 3, F.col("n_dup_lines") * 10 <= F.col("n_lines")),
        "repeats": vote(F.col("n_repeat_words") * 10 > n * 3, F.col("n_repeat_words") * 10 <= n),
        "capitals": vote(F.col("n_upper") * 5 > F.col("word_chars"), F.col("n_upper") * 10 <= F.col("word_chars")),
        "small_words": vote(F.col("n_small") == 0, F.col("n_small") >= 4),
    }


@dataclass(frozen=True)
class Accuracy:
    """How often a rule that votes is right on good and on bad documents."""

    good: float = 0.95
    bad: float = 0.5


def _log_odds(prior: float, rules: dict[str, Accuracy]) -> Column:
    """Log odds of a good document: a vote adds the log of how much likelier good documents get it."""
    total = F.lit(math.log(prior / (1 - prior)))
    for rule, a in rules.items():
        total = total + F.when(F.col(rule) == 1, F.lit(math.log(a.good / (1 - a.bad)))).when(
            F.col(rule) == -1, F.lit(math.log((1 - a.good) / a.bad))).otherwise(0.0)
    return total


def _probability(prior: float, rules: dict[str, Accuracy]) -> Column:
    return 1 / (1 + F.exp(-_log_odds(prior, rules)))


def estimate(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[float, dict[str, Accuracy]]:
    """(share of good documents, accuracies) from rows of votes with a count ``n``.

    Starts at 0.9 good documents. A rule is taken to be right on good documents nine times in ten
    at least, which also tells the good class from the bad. All rounds are one expression over an
    array of the patterns (3^rules entries at most), so one job gives one row.
    """
    votes = F.array(*[F.col(name) for name in names])
    start = Accuracy()
    rule = f"sequence(0, {len(names) - 1})"

    def total(what: str, side: str) -> str:
        return f"aggregate(w, 0D, (t, x) -> t + if({what}, x.{side}, 0D))"

    def share(right: int, side: str) -> str:  # with one vote of each kind beside the counted ones
        return (f"({total(f'x.v[j] = {right}', side)} + 1) / ({total('x.v[j] <> 0', side)} + 2)")

    odds = f"""ln(s.prior / (1 - s.prior)) + aggregate({rule}, 0D, (t, j) -> t + CASE x.v[j]
        WHEN 1 THEN ln(s.good[j] / (1 - s.bad[j])) WHEN -1 THEN ln((1 - s.good[j]) / s.bad[j]) ELSE 0D END)"""
    sides = f"""transform(transform(patterns, x -> named_struct('v', x.v, 'n', x.n, 'p', 1 / (1 + exp(-({odds}))))),
        x -> named_struct('v', x.v, 'good', x.n * x.p, 'bad', x.n * (1 - x.p)))"""
    state = f"""transform(array({sides}), w -> named_struct(
        'prior', least(greatest({total('true', 'good')} / greatest({total('true', 'good')} + {total('true', 'bad')}, 1D), 0.01D), 0.99D),
        'good', transform({rule}, j -> least(greatest({share(1, 'good')}, 0.9D), 0.9999D)),
        'bad', transform({rule}, j -> least(greatest({share(-1, 'bad')}, 0.01D), 0.99D))))[0]"""
    first = f"""named_struct('prior', 0.9D, 'good', array_repeat({start.good}D, {len(names)}),
        'bad', array_repeat({start.bad}D, {len(names)}))"""
    row = (patterns.agg(F.sort_array(F.collect_list(F.struct(votes.alias("v"), F.col("n").cast("double").alias("n")))).alias("patterns"))
           .select(F.expr(f"aggregate(sequence(1, {rounds}), {first}, (s, i) -> {state})").alias("found")).first())
    return row.found.prior, {name: Accuracy(g, b) for name, g, b in zip(names, row.found.good, row.found.bad)}


def judge_quality(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Figures, base verdict, probability of being good and verdict for every document, beside the
    columns ``keep``.

    A null or empty text has no words and fails the base limits. Repeated rows are judged alike;
    all rows count in the estimates. An empty table gives no rows.
    """
    kept = [F.col(f"`{name}`").alias(f"keep{i}") for i, name in enumerate(keep)]
    votes = rule_votes()
    figures = materialise(count_figures(docs, text, kept).withColumns(votes))
    prior, rules = estimate(figures.groupBy(*votes).agg(F.count("*").alias("n")), list(votes))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return figures.select(
        *[F.col(f"keep{i}").alias(name) for i, name in enumerate(keep)], *COUNTS,
        failed.alias("base_failed"),
        (~failed & (_log_odds(prior, rules) >= 0)).alias("kept"),
        F.round(_probability(prior, rules), 6).alias("probability"))
