"""Quality rules kept as a ledger of failure bits and measurements.

Every rule is evaluated once for a text. The ledger row holds what was measured and one bit for
each rule that failed, so a policy (a versioned set of rules) is one bitwise AND, and an ablation
(what would change without a rule) needs only the counts of the bit patterns, never the texts.

Words are runs of anything but ASCII white space. Defined results for odd input: a null or empty
text has no words, so all measurements are 0 and `few_words` fails; a text of any length is
measured whole, in pieces that hold whole texts; rows are judged one by one, so repeated rows get
repeated ledgers; an empty table gives an empty ledger; columns of the input stay as they are, and
the ledger's struct column takes a name that the input doesn't use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from collections import defaultdict
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from terrace.llm.texts import free_name, per_value, pieces, utf8, values

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WORD_CHAR = ~_SPACE & ((np.arange(256) & 0xC0) != 0x80)  # a code point starts here
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rule:
    """`fails` is a SQL condition over the measurements, in whole numbers so that no rounding decides."""
    name: str
    fails: str


#: A rule's place is its bit in the ledger: append only.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
)
BIT = {rule.name: 1 << place for place, rule in enumerate(RULES)}
BASE = ("few_words", "repeated_windows")
#: Versions are never changed once used; a new set of rules gets a new version.
POLICIES = {
    "base": BASE,
    "2024-1": (*BASE, "many_symbols"),
    "2024-2": (*BASE, "short_words", "long_words", "many_symbols", "repeated_lines"),
}
CURRENT = "2024-2"


def mask(rules: tuple[str, ...]) -> int:
    return reduce(lambda bits, name: bits | BIT[name], rules, 0)


def _repeated_words(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which words lie in a window of eight that its text holds more than once.

    Windows are numbered by doubling (pairs, fours, eights), so equal numbers mean equal words.
    """
    covered = np.zeros(len(ids) + 1, np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    number, span = ids.astype(np.int64), 1
    if len(ids) < WINDOW:
        return covered[:-1]
    while span < WINDOW:
        pair = number[:-span] * (number.max() + 1) + number[span:]
        _, number = np.unique(pair, return_inverse=True)
        span *= 2
    starts = np.flatnonzero(text[:len(number)] == text[WINDOW - 1:])
    key = number[starts] * np.int64(len(at)) + text[starts]
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    found = starts[times[back] > 1]
    np.add.at(covered, found, 1)
    np.add.at(covered, found + WINDOW, -1)
    return np.cumsum(covered)[:-1] > 0


def measure(texts: pa.Array) -> list[np.ndarray]:
    """The MEASURES of each text, in that order."""
    data, ends = utf8(texts)
    each = values(texts)
    number = defaultdict(count().__next__).__getitem__
    words = [text.split() for text in each]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    at = np.concatenate([[0], np.cumsum(n_words)])
    ids = np.fromiter((number(w) for ws in words for w in ws), np.int64, int(at[-1]))
    n_lines, n_dup = np.zeros(len(each), np.int64), np.zeros(len(each), np.int64)
    for i, text in enumerate(each):
        if n_words[i]:
            lines = [line for line in text.split(b"\n") if line.strip()]
            n_lines[i], n_dup[i] = len(lines), len(lines) - len(set(lines))
    return [n_words, per_value(_WORD_CHAR[data], ends), per_value(_SYMBOL[data], ends), n_dup,
            per_value(_repeated_words(ids, at), at), n_lines]


def ledger(docs: DataFrame, text: str = "text", into: str = "ledger") -> tuple[DataFrame, str]:
    """`docs` with a struct of the measurements and `failed`, the rules' bits; and its name."""
    into = free_name(docs, into)
    kept = docs.columns
    measured = StructType([StructField(name, LongType()) for name in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            found = pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in measure(batch.column(text))], list(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*kept, into])

    out = docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, measured)]))
    fields = {name: f"`{into}`.`{name}`" for name in MEASURES}

    def bit(rule: Rule) -> Column:
        said = " ".join(fields.get(word, word) for word in rule.fails.split())
        return F.when(F.expr(said), F.lit(BIT[rule.name])).otherwise(F.lit(0))

    failed = reduce(Column.bitwiseOR, map(bit, RULES)).cast("long")
    return out.withColumn(into, F.col(f"`{into}`").withField("failed", failed)), into


def passes(failed: Column, policy: str = CURRENT) -> Column:
    return failed.bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def kept_rows(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows that pass the policy, with the columns they came with."""
    judged, name = ledger(docs, text)
    return judged.filter(passes(F.col(f"`{name}`.failed"), policy)).drop(name)


def ablation(failed: DataFrame, policy: str = CURRENT, column: str = "failed") -> DataFrame:
    """For each rule of the policy: rows failing it, failing it alone, and rejected without it.

    The rows are first counted by bit pattern (at most 2 to the number of rules), in the map tasks.
    """
    whole = mask(POLICIES[policy])
    patterns = failed.groupBy(F.col(column).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long").alias("bit"))
        for name in POLICIES[policy]))).alias("r")
    hit = F.col("bits").bitwiseAND(F.lit(whole))
    rest = F.col("bits").bitwiseAND(F.lit(whole).cast("long").bitwiseXOR(F.col("bit")))
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return (patterns.select("bits", "n", rules).select("bits", "n", "r.*")
            .groupBy("rule").agg(
                total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
                total(hit == F.col("bit")).alias("n_failed_alone"),
                total(rest != 0).alias("n_rejected_without")))
