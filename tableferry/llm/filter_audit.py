"""What each of five document filters removes, alone and in every order of application.

Words and different words of a text are the row sums and entry counts of a document-term matrix (``term_matrix``); they
decide filters A and B. C and D are told by the text's bytes. E, a text equal to that of a smaller id, is decided on SHA-256 of texts: copies
are first counted per part, verdict and labels, then the smallest id of a text is joined to these few
rows, so a text that a third of the corpus repeats moves as one row per part, verdict, labels and task. A part's
outcome in all 120 orders follows from the counts of its 32 patterns of failures.

Null texts count as empty (A fails, B to D pass, E as any equal texts). A null part is the part ''. Rows without an id never fail E,
nor does anything fail by them; rows that repeat an id are rows of their own, and those with the smallest id of a text all pass E. A document whose
labels are repeated has the largest ones. No documents: no parts, no rows. Columns not named are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.shared import settle
from tableferry.llm.term_matrix import row_totals, term_matrix

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DIFFERENT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
MARKS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))

FACTS = "doc_id:bigint, part:string, capitals:bigint, points:bigint, marked:boolean, digest:binary"


def _told(text: bytes) -> tuple:
    """Capitals, code points, whether a mark is held, and the digest of a text."""
    points = len(text.decode())
    return len(text) - len(text.translate(None, CAPITALS)), points, len(text.translate(None, MARKS)) < len(text), hashlib.sha256(text).digest()


def document_facts(docs: DataFrame, part: str = "source") -> DataFrame:
    """Per document: doc_id, part, capitals, points, marked, digest, n_words, n_different."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    matrix, _ = term_matrix(known, ["doc_id", "part"], FACTS, _told)
    return row_totals(matrix, FACTS)


def failures() -> Column:
    """Bits of the filters A to D that a document fails."""
    failed = [
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_different") < LEAST_DIFFERENT_PERCENT * F.col("n_words"),
        100 * F.col("capitals") > MOST_CAPITALS_PERCENT * F.col("points"),
        F.col("marked"),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed)), F.lit(0))


def patterns(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents of each part by the bits of the filters they fail, and the labelled among them."""
    told = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = facts.select("doc_id", "part", "digest", failures().alias("failed")).groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n"))
    known = rows.join(told, rows.doc_id == told.id, "left")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    kinds = known.groupBy("digest", "part", "failed", F.col("quality").eqNullSafe(1).alias("good"), F.col("toxic").eqNullSafe(1).alias("toxic")).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unknown"), first.alias("first")
    )
    kinds = settle(kinds, "kinds")
    least = kinds.groupBy(F.col("digest").alias("of")).agg(F.min("first.doc_id").alias("least"))
    passed = F.col("unknown") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.explode(F.array(F.struct(F.col("failed").alias("bits"), passed.alias("m")), F.struct((F.col("failed") + 16).alias("bits"), (F.col("n") - passed).alias("m"))))
    both = kinds.join(least, F.col("digest") == F.col("of")).select("part", "good", "toxic", split.alias("s"))
    return both.groupBy("part", F.col("s.bits").alias("failed")).agg(
        F.sum("s.m").alias("n"), F.sum(F.when(F.col("good"), F.col("s.m")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("s.m")).otherwise(0)).alias("toxic")
    )


def _steps() -> Column:
    """The 600 steps of all orders: order, step, the step's filter as a bit, and the bits of those applied before."""
    out = []
    for order in sorted("".join(p) for p in permutations(FILTERS)):
        before = 0
        for k, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            out.append(f"named_struct('o', '{order}', 's', {k + 1}, 'b', {bit}, 'a', {before})")
            before |= bit
    return F.expr(f"array({', '.join(out)})")


def outcomes(counted: DataFrame) -> DataFrame:
    """A row per part, order and step, from the counts of patterns."""
    kinds = range(1 << len(FILTERS))
    cells = [F.coalesce(F.sum(F.when(F.col("failed") == k, F.col(c))), F.lit(0)) for c in ("n", "good", "toxic") for k in kinds]
    size = len(kinds)
    wide = counted.groupBy("part").agg(*(c.alias(f"c{k}") for k, c in enumerate(cells)))
    arrays = [F.array(*(f"c{i * size + k}" for k in kinds)).alias(c) for i, c in enumerate(("n", "good", "toxic"))]
    rows = wide.select("part", *arrays).select("*", F.explode(_steps()).alias("t"))
    bit, before = F.col("t.b"), F.col("t.a")

    def total(column: str, wanted, value=lambda c, k: c) -> Column:
        """Sum over the patterns k that are ``wanted``."""
        numbered = F.transform(column, lambda c, k: F.when(wanted(k), value(c, k)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(numbered, F.lit(0).cast("long"), lambda a, x: a + x)

    def fails(k: Column) -> Column:
        return k.bitwiseAND(bit) != 0

    def removed(k: Column) -> Column:
        return fails(k) & (k.bitwiseAND(before) == 0)

    # A pattern of f failures is removed by each of its filters in 120 / f of the orders.
    return rows.select(
        "part",
        F.col("t.o").alias("filter_order"),
        F.col("t.s").cast("int").alias("step"),
        total("n", lambda k: k.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda k: fails(k) & (k.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda k: k == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("n", fails, lambda c, k: c * (F.lit(120) / F.greatest(F.bit_count(k), F.lit(1))).cast("long")).alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return outcomes(patterns(document_facts(docs, part), labels))
