"""Quality rules as a ledger: every rule is evaluated once, policies read its bits.

``ledger`` adds one row's measurements and one bit per rule that the row fails.
A policy is a named, versioned set of rules; ``apply_policy`` decides by its mask, and
``ablations`` counts from the bits alone what each rule of a policy does. No text is
read again for another policy. Only DataFrame functions are used.

Words are runs of other characters than space and \\t \\n \\v \\f \\r. A NULL or empty
text has no words: it fails ``few_words`` and no rule that divides by words or lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"

# Name, condition under which a row fails. The place in the list is the bit; rules are
# only ever added at the end, so that old ledgers stay readable.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("many_words", "n_words > 1000000"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
]


@dataclass(frozen=True)
class Policy:
    """A version of a set of rules; a row is kept if it fails none of them."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[rule] for rule in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES = {
    1: BASE,
    2: Policy(
        "web", 2,
        ("few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words",
         "long_words"),
    ),
}
CURRENT = POLICIES[2]


def _halves(name: str, step: int, length: str) -> Column:
    """Hashes of windows of twice as many words: of the hash ``step`` further on too."""
    size = F.expr(length)
    return F.zip_with(
        F.slice(name, F.lit(1), size),
        F.slice(name, F.lit(step + 1), size),
        lambda a, b: F.xxhash64(a, b),
    )


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a column ``measures``; a column of that name is replaced.

    Windows of 8 words are compared by 64-bit hashes that are built by doubling, so the
    work is linear in the words, and n log n where windows repeat.
    """
    have = [c for c in df.columns if c != "measures"]
    row = F.struct(*[F.col(f"`{c}`") for c in have]).alias("row") if have else F.lit(None)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = df.select(row, whole.alias("t"))
    df = df.select(
        "row",
        "t",
        F.array_remove(F.split("t", "[ \\t-\\r]+"), "").alias("w"),
        F.filter(
            F.split("t", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != ""
        ).alias("lines"),
    )
    df = df.select(
        "row",
        F.size("w").alias("n"),
        F.char_length(F.array_join("w", "")).alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("w") > WINDOW, F.transform("w", lambda x: F.xxhash64(x))).alias("h1"),
    )
    kept = ["row", "n", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    df = df.select(*kept, _halves("h1", 1, "n - 1").alias("h2"))
    df = df.select(*kept, _halves("h2", 2, "n - 3").alias("h4"))
    df = df.select(*kept, _halves("h4", 4, "n - 7").alias("h8"))
    # Rows whose windows all differ stop here.
    ordered = F.sort_array(
        F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    repeats = F.size(F.array_distinct("h8")) < F.size("h8")
    df = df.select(*kept, F.when(repeats, ordered).alias("s"))
    twin = F.filter(
        F.transform(
            "s",
            lambda x, k: F.when(
                (x["h"] == F.get("s", k - 1)["h"]) | (x["h"] == F.get("s", k + 1)["h"]),
                x["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    df = df.select(*kept, F.sort_array(twin).alias("starts"))
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda i, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - i, F.lit(WINDOW))
            ),
        ),
        F.lit(0),
        lambda total, words: total + words,
    )
    found = {
        "n_words": F.col("n"),
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_lines": F.col("n_lines"),
        "n_dup_lines": F.col("n_dup_lines"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    measured = F.struct(*[found[m].cast("long").alias(m) for m in MEASURES])
    # Filters on the measures stay above the generator: below it, the optimizer would
    # put the whole computation into them, once for each mention.
    return df.select(
        *[F.col(f"row.`{c}`").alias(c) for c in have],
        F.explode(F.array(measured)).alias("measures"),
    )


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``measures`` and ``failed_bits`` (bit i: rule i of RULES fails).

    Columns of those names are replaced. Texts are measured whole, however long.
    """
    measured = measures(df.drop("failed_bits", "measures"), text)
    bits = F.lit(0).cast("long")
    for name, condition in RULES:
        for measure in MEASURES:
            condition = condition.replace(measure, f"measures.{measure}")
        bits = bits + F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0))
    return measured.withColumn("failed_bits", bits)


def passes(policy: Policy) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(df: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The rows of a ledger that a policy keeps."""
    return df.filter(passes(policy))


def ablations(df: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of a policy: rows failing it, failing it alone, kept without it.

    Rows are counted by their failure bits first, at most 2^rules groups.
    """
    mask = F.col("failed_bits").bitwiseAND(F.lit(policy.mask))
    patterns = df.groupBy(mask.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in policy.rules]
    )
    each = patterns.select("bits", "n", F.explode(rules).alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")

    def total(when):
        return F.sum(F.when(when, F.col("n")).otherwise(0))

    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(fails).alias("n_failed"),
        total(alone).alias("n_failed_alone"),
        total((F.col("bits") == 0) | alone).alias("n_kept_without"),
        F.sum("n").alias("n_rows"),
    )
