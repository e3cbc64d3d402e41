"""Operator 11: fill-in-middle transformation by repeated-capture matching.

One ``regex`` fullmatch of ``(unit)*`` keeps the end of every repetition of the unit, so ``match.ends(1)`` gives the
number of units and both cut offsets; nothing walks over the units. A unit is a run of white space with the word
after it, or the white space that ends a text. The cuts, the form and the share of plain texts come from the digits
of a hash of the seed and the document's id, so a repeated run or a recomputed task gives the same rows.

A null text counts as empty; an empty text has no unit and stays plain. So does a text that holds one of the three
marks, for its output could not be read back. A null id hashes as the empty string. Repeated rows each give their
(equal) row; an empty table gives none; extra columns don't matter. A text longer than ``BLOCK_CHARS`` is matched in
blocks of at most ``BLOCK_UNITS`` units, one after the other, because a match holds about 170 bytes for each unit
that it captured; the ends are the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphspark.llm.common import text_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The atomic group keeps no places to come back to, and every repetition of the inner group is captured.
_UNIT = "(?>([\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+))"
BLOCK_UNITS = 1_000_000
BLOCK_CHARS = 2 * BLOCK_UNITS
_UNITS = regex.compile(f"{_UNIT}*")
_BLOCK = regex.compile(f"{_UNIT}{{1,{BLOCK_UNITS}}}")

FIM_SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


def unit_ends(text: str) -> np.ndarray:
    """Where each unit of the text ends, in code points."""
    if len(text) <= BLOCK_CHARS:
        return np.array(_UNITS.fullmatch(text).ends(1), np.int64)
    blocks, at = [], 0
    while at < len(text):
        match = _BLOCK.match(text, at)
        blocks.append(np.array(match.ends(1), np.int64))
        at = match.end()
    return np.concatenate(blocks)


def draws(seed: int, doc_id: str | None) -> list[int]:
    """The four numbers that decide a document: the first four 8-digit groups of the hash."""
    digits = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    return [int(digits[at:at + 8], 16) for at in (0, 8, 16, 24)]


def cut(text: str | None, doc_id: str | None, seed: int, fim_percent: int, spm_percent: int) -> tuple:
    """One document's row of ``FIM_SCHEMA``."""
    text = text or ""
    ends = unit_ends(text)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= fim_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return len(ends), "plain", None, None, text
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_percent:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return len(ends), form, len(prefix), len(middle), output


def transform(docs: DataFrame, *keep: str, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and ``_fim``, a struct of ``FIM_SCHEMA``. No shuffle."""
    text_batches(docs.sparkSession)

    @F.pandas_udf(FIM_SCHEMA)
    def fim(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [cut(t, i, seed, fim_percent, spm_percent) for i, t in zip(ids, texts)]
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return docs.select(*keep, fim(F.col(id_col).cast("string"), F.col(text_col)).alias("_fim"))


def restored(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form alone: no part of it holds a mark, so marks are where they stand."""
    def between(start: Column, end: Column) -> Column:  # places from 1
        return F.substring(output, start, end - start)

    marks = F.lit(len(PREFIX))
    first_s, first_p, first_m = (F.instr(output, mark) for mark in (SUFFIX, PREFIX, MIDDLE))
    end = F.char_length(output) + 1
    middle = between(first_m + marks, end)
    psm = F.concat(between(marks + 1, first_s), middle, between(first_s + marks, first_m))
    spm = F.concat(between(first_p + marks, first_m), middle, between(marks + 1, first_p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digits
           FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
             CAST('0x' || substr(digits, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digits, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(digits, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digits, 25, 8) AS BIGINT) AS h4
      FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM u),
p AS (SELECT doc_id, n, form, text, array_to_string(units[1:a], '') AS prefix,
             array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
