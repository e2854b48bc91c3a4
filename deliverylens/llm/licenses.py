"""License scan: an Aho-Corasick automaton finds identifier tags and notice phrases,
and a shunting-yard parser evaluates the licence expressions behind the tags.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.llm.words import alnum_words, utf8

# The phrases whose places are counted, with their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notice phrases (words as the scan splits them) and the licence they name.
NOTICE_PHRASES = {
    "apache license version 2 0": "apache-2.0",
    "mit license": "mit",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "mozilla public license version 2 0": "mpl-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "cc0 1 0": "cc0-1.0",
}
# Licence and exception identifiers that a tag may name.
LICENSE_IDS = frozenset(
    "0bsd agpl-3.0-only agpl-3.0-or-later apache-2.0 bsd-2-clause bsd-3-clause bsl-1.0 cc-by-4.0 cc-by-nc-4.0"
    " cc-by-nd-4.0 cc-by-sa-4.0 cc0-1.0 epl-2.0 gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only"
    " gpl-3.0-or-later isc lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-only lgpl-3.0-or-later mit mpl-2.0 unlicense"
    " zlib".split()
)
EXCEPTION_IDS = frozenset("classpath-exception-2.0 gcc-exception-3.1 llvm-exception linux-syscall-note".split())

TAG = "spdx license identifier"
TAGGED = re.compile(r"(?i:spdx-license-identifier):[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"[A-Za-z0-9.+-]+|[()]")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

# how sure a kind of evidence is
KNOWN, UNKNOWN, NOTICE, BASE = 1.0, 0.5, 0.8, 0.6


def evaluate_expression(text: str) -> tuple[list[str], float]:
    """The identifiers of a licence expression and how sure it is.

    ``with`` binds closer than ``and``, that closer than ``or``; operators are read
    in either case and group to the left. A known identifier counts 1, another 0.5;
    ``and`` and ``with`` take the weaker side, ``or`` the stronger one. Reading ends
    at the first word that cannot go on an expression (a comment's end, prose), and
    an expression that is malformed up to there gives ([], 0).
    """
    names: list[str] = []
    values: list[float] = []
    pending: list[str] = []

    def reduce() -> None:
        op, right, left = pending.pop(), values.pop(), values.pop()
        values.append(max(left, right) if op == "or" else min(left, right))

    operand_next = True
    for token in TOKEN.findall(text):
        word = token.lower()
        if operand_next:
            if word == "(":
                pending.append("(")
                continue
            if word in PRECEDENCE or word == ")":
                return [], 0.0
            exception = bool(pending) and pending[-1] == "with"
            known = EXCEPTION_IDS if exception else LICENSE_IDS
            names.append(word)
            values.append(KNOWN if word in known or word.removesuffix("+") in known else UNKNOWN)
            operand_next = False
        elif word == ")":
            if "(" not in pending:
                break
            while pending[-1] != "(":
                reduce()
            pending.pop()
        elif word in PRECEDENCE:
            while pending and pending[-1] != "(" and PRECEDENCE[pending[-1]] >= PRECEDENCE[word]:
                reduce()
            pending.append(word)
            operand_next = True
        else:
            break
    if operand_next or "(" in pending:
        return [], 0.0
    while pending:
        reduce()
    return names, values[0]


@cache
def phrase_automaton() -> ahocorasick.Automaton:
    """Phrases between spaces, so that only whole words match."""
    machine = ahocorasick.Automaton()
    for phrase in {**BASE_PHRASES, **NOTICE_PHRASES, TAG: TAG}:
        machine.add_word(f" {phrase} ", phrase)
    machine.make_automaton()
    return machine


def scan_text(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = alnum_words(utf8(text))
    # one character a byte: the phrases are ASCII, and other bytes cannot match them
    line = f" {b' '.join(words).decode('latin-1')} "
    n_base, first, last = 0, None, None
    base, labels, score, tagged = set(), set(), 0.0, False
    counted_to = index = 0
    starts = []
    for end, phrase in phrase_automaton().iter(line):
        if phrase in BASE_PHRASES:
            starts.append(end - len(phrase) - 1)
            base.add(BASE_PHRASES[phrase])
            score = max(score, BASE)
        if phrase in NOTICE_PHRASES:
            labels.add(NOTICE_PHRASES[phrase])
            score = max(score, NOTICE)
        tagged |= phrase == TAG
    for start in sorted(starts):
        index += line.count(" ", counted_to, start)
        counted_to = start
        first = index if first is None else first
        last = index
        n_base += 1
    if tagged:
        for found in TAGGED.finditer(text):
            names, sure = evaluate_expression(found[1])
            labels.update(names)
            score = max(score, sure)
    joined = ",".join(sorted(base | labels))
    return len(words), n_base, first, last, ",".join(sorted(base)), joined, score


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@F.pandas_udf(RESULT)
def _scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        out = pd.DataFrame([scan_text(t) for t in batch], columns=RESULT.names)
        for name in ("first_word", "last_word"):
            out[name] = out[name].astype("Int64")
        yield out


def license_findings(text: Column) -> Column:
    """A struct of what ``scan_text`` finds, for each value of a text column."""
    return _scan(text)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Licence evidence of every document, one row for each input row.

    Null and empty texts have no words, no labels and score 0; ``first_word`` and
    ``last_word`` are null where no base phrase occurs. Repeated rows and null keys
    stay as they are; no other column of ``docs`` is read, whatever its name.
    An empty table gives an empty result.
    """
    return docs.select(F.col(key).alias("doc_id"), license_findings(F.col(text)).alias("found")).select(
        "doc_id", "found.*"
    )
