"""Fill-in-the-middle: texts cut at line ends into prefix, middle and suffix, and put in another order.

A text is cut into lines (``UNIT``, matched left to right). Two numbers from the SHA-256 of a document's key choose
between which lines the prefix and the middle end; a third whether the text is transformed at all, a fourth in which
order: ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), each part behind its sentinel. Nothing
depends on the other rows, the partitions or the attempt, so that a lost task's repetition gives the same rows.

The work is one Arrow-batched pandas UDF: ``regex`` finds the units, their end offsets lie in a compact array, two
lookups slice the text, ``hashlib`` gives numbers and digests. There is no shuffle.

Nulls and odd rows: a null text is an empty one, and an empty one stays as it is (``plain``), as does a text that holds
a sentinel. A null ``doc_id`` is written as nothing, so that its key is the seed and a colon. Repeated rows give
repeated rows. An empty table gives no rows. Extra columns pass through, other than those named like the output's.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

UNIT = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Of a hundred texts, how many are transformed, and of a hundred of these, how many become spm.
RATE, SPM_RATE = 100, 50
FIELDS = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"]
STRUCT = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Raises unless a text without sentinels can always be told from the sentinels put around its parts: none may lie
    in another, and no end of one may be the beginning of one."""
    if len(set(sentinels)) < 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"the sentinels {a!r} and {b!r} overlap")


def numbers(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The four numbers that decide over a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else int(doc_id)}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def unit_ends(text: str, pattern: regex.Pattern) -> array:
    return array("q", (m.end() for m in pattern.finditer(text)))


def cut(text: str, ends: array, h1: int, h2: int) -> tuple[str, str, str]:
    """(prefix, middle, suffix) by the two places that h1 and h2 choose among the units' ends."""
    n = len(ends)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends[first - 1] if first else 0, ends[second - 1] if second else 0
    return text[:a], text[a:b], text[b:]


def joined(form: str, prefix: str, middle: str, suffix: str, sentinels: tuple[str, str, str]) -> str:
    p, s, m = sentinels
    return "".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle))


def restored(output: str, form: str, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> str:
    """The text from which an output was made."""
    if form == "plain":
        return output
    p, s, m = sentinels
    head, middle = output.split(m)
    if form == "psm":
        prefix, suffix = head.removeprefix(p).split(s)
    else:
        suffix, prefix = head.removeprefix(s).split(p)
    return prefix + middle + suffix


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def transformed(doc_id: Column, text: Column, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), unit: str = UNIT, with_output: bool = True) -> Column:
    """Struct of ``FIELDS``; ``output`` is null without ``with_output``, which spares its way back from Python."""
    check_sentinels(sentinels)

    def one(doc: int | None, text: str, pattern: regex.Pattern) -> tuple:
        h1, h2, h3, h4 = numbers(doc, seed)
        ends = unit_ends(text, pattern)
        if not text or h3 % 100 >= rate or any(x in text for x in sentinels):
            form, sizes, output = "plain", (None, None), text
        else:
            form = "spm" if h4 % 100 < spm_rate else "psm"
            prefix, middle, suffix = cut(text, ends, h1, h2)
            sizes, output = (len(prefix), len(middle)), joined(form, prefix, middle, suffix, sentinels)
        return (len(ends), form, *sizes, output if with_output else None, _digest(output), _digest(restored(output, form, sentinels)))

    @F.pandas_udf(STRUCT)
    def run(docs: pd.Series, texts: pd.Series) -> pd.DataFrame:
        pattern = regex.compile(unit)
        rows = [one(None if not d else int(d), t, pattern) for d, t in zip(docs, texts)]
        found = pd.DataFrame(rows, columns=FIELDS)
        return found.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64", **{c: object for c in ("form", "output", "output_sha256", "restored_sha256")}})

    # ids travel as text: pandas would turn a column with nulls into doubles, which don't hold every long
    return run(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.coalesce(text, F.lit("")))


def fill_in_middle(docs: DataFrame, with_output: bool = True, **how) -> DataFrame:
    """``docs`` with the columns ``FIELDS``; columns of those names are replaced."""
    storage.bound_batches(docs.sparkSession)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in FIELDS]
    made = docs.select(F.struct(*own).alias("own"), transformed(F.col("doc_id"), F.col("text"), with_output=with_output, **how).alias("made"))
    return made.select(*[F.col(f"own.`{c}`").alias(c) for c in docs.columns if c not in FIELDS], *[F.col(f"made.{c}").alias(c) for c in FIELDS if with_output or c != "output"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every document, cut and reordered, by its digests."""
    made = fill_in_middle(storage.documents(spark, sf_dir).select("doc_id", "text"), with_output=False)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
