"""Quality rules kept as a ledger of bits.

``ledger`` measures every text once and evaluates every rule once: one bit for each rule, in ``failed``, beside
the measurements. A policy is a named, versioned mask over these bits; ``apply_policy`` and ``ablation`` read
only the ledger, so that a new policy costs no pass over the texts.

Besides the rules that hold anywhere, one asks for words that begin like those of texts labelled toxic: ``toxic_stems`` learns
these beginnings from a bounded number of labelled documents.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: a null text counts as one without words (it fails the base rules);
null doc_ids and repeated rows are kept row by row; an empty table gives an empty ledger; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import documents, materialize

QUERY = "op10_quality_rules"

# Words that insult.
TOXIC_TERMS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")

#: Rules in the order of their bits, each as an expression over the measurements that is true when a text fails.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("long_words", "word_chars > 12 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("upper_case", "2 * n_upper > n_letters AND n_letters >= 20"),
    ("toxic_terms", "n_toxic >= 2 OR 100 * n_toxic >= n_words AND n_toxic > 0"),
    ("toxic_stems", "n_stems >= 2 AND 100 * n_stems >= n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]

#: Versions of the policy: which failed rules remove a text.
POLICIES = {
    "base-1": BASE,
    "web-1": BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["long_words"] | BIT["short_words"] | BIT["upper_case"],
    "web-2": (1 << 8) - 1,
    "web-3": (1 << 9) - 1,
}
CURRENT = "web-3"

#: Labelled documents that the stems are learned from, in the order of a hash of doc_id; lengths of stems; and what makes one telling: it stands in
#: STEM_LEAST toxic texts and in one of STEM_SHARE of them, and STEM_RATIO times as often there as in others.
FIT_ROWS = 6000
STEM_LENGTHS = range(3, 9)
STEM_LEAST, STEM_SHARE, STEM_RATIO = 4, 25, 10

_TOXIC = re.compile(rf"(?<![0-9A-Za-z_])(?:{'|'.join(TOXIC_TERMS)})(?![0-9A-Za-z_])")
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_toxic", "n_stems")
_SPACES = bytes(range(9, 14)) + b" "


def _repeated(words: list[bytes]) -> int:
    """Words that stand in some 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    k = len(numbers)
    pairs = code[:-1] * k + code[1:]
    if k < 2_000_000:
        windows = pairs[:-1] * k + code[2:]
    else:  # three codes would not fit 63 bits
        windows = np.unique(pairs, return_inverse=True)[1][:-1] * k + code[2:]
    order = np.argsort(windows, kind="stable")
    sorted_ = windows[order]
    same = sorted_[1:] == sorted_[:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(n, bool)
    marked[:-2] |= twice
    marked[1:-1] |= twice
    marked[2:] |= twice
    return int(marked.sum())


def stem_pattern(stems: list[str]) -> re.Pattern | None:
    """Finds words, of letters only, that begin with a stem."""
    return re.compile(rf"(?<![^\W\d_])(?:{'|'.join(map(re.escape, stems))})") if stems else None


def measure(text: str | None, stems: re.Pattern | None = None) -> tuple[int, ...]:
    """The measurements of one text, in the order of the ledger's columns."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACES)]
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(raw) - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    toxic = len(_TOXIC.findall((text or "").translate(_ASCII_LOWER) if upper else text or ""))
    return len(words), len(text or "") - spaces, symbols, len(lines) - len(set(lines)), _repeated(words), len(lines), upper, upper + lower, toxic, len(stems.findall((text or "").lower())) if stems else 0


_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def _words_of(text: str) -> set[str]:
    return set(re.findall(r"[^\W\d_]+", text.lower()))


def toxic_stems(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[str]:
    """Beginnings of words that tell toxic documents, from (doc_id, toxic) labels of at most ``fit_rows`` documents; none without both kinds."""
    by_hash = F.md5(F.col("doc_id").cast("string").cast("binary"))
    chosen = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").orderBy(by_hash, "doc_id", "toxic").limit(fit_rows)
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").distinct()  # fit_rows small rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                own = counts[int(toxic == 1)]
                own[""] += 1  # the texts themselves
                own.update({w[:k] for w in _words_of(text) for k in STEM_LENGTHS if len(w) >= k})
        yield pd.DataFrame([(stem, int(toxic), n) for toxic, own in enumerate(counts) for stem, n in own.items()], columns=["stem", "toxic", "n"])

    sums = rows.select("text", "toxic").mapInPandas(run, "stem string, toxic int, n long").groupBy("stem")
    sums = sums.agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    sums = materialize(sums, "toxic-stems")
    totals = sums.where("stem = ''").first()
    if not totals or not totals.t or not totals.c:
        return []
    # each stands in one of STEM_SHARE toxic texts of the sample, so there are few
    good = sums.where(f"stem <> '' AND t >= {STEM_LEAST} AND {STEM_SHARE} * t >= {totals.t} AND t * {totals.c} > {STEM_RATIO} * (c + 1) * {totals.t}")
    found = {r.stem for r in good.select("stem").collect()}
    return sorted(x for x in found if not any(x[:k] in found for k in range(STEM_LENGTHS.start, len(x))))


def measurements(docs: DataFrame, stems: list[str]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern = stem_pattern(stems)
        for frame in frames:
            rows = [measure(text, pattern) for text in frame["text"]]
            out = pd.DataFrame(rows, columns=_MEASURES, dtype="int64")
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, " + ", ".join(f"{m} long" for m in _MEASURES))


def ledger(docs: DataFrame, stems: list[str] | None = None) -> DataFrame:
    """doc_id, the measurements and ``failed``: the bits of the rules that the text fails."""
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measurements(docs, stems or []).withColumn("failed", failed)


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Adds ``kept``: no rule of the policy's mask failed."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(POLICIES[version])) == 0)


def ablation(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: texts that fail it, that fail it alone, and that the policy would keep without it."""
    mask = POLICIES[version]
    within = F.col("failed").bitwiseAND(F.lit(mask))
    counts = rows.groupBy(within.alias("bits")).count()  # at most 2 ** rules rows
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in BIT.items() if b & mask]))
    return (
        counts.select("bits", "count", names.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.expr("bits & r.bit != 0"), F.col("count")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.expr("bits = r.bit"), F.col("count")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.expr("(bits & ~r.bit) = 0"), F.col("count")).otherwise(0)).alias("n_kept_without"),
        )
    )


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    stored = materialize(ledger(docs, toxic_stems(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))), "quality-ledger")
    rows = apply_policy(stored)
    base = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")


ORACLE_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
d AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g),
m AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM d WHERE n > 1) GROUP BY r),
fit AS (SELECT DISTINCT d.doc_id, d.text, l.toxic FROM (SELECT doc_id, toxic FROM labels WHERE doc_id IS NOT NULL AND toxic IS NOT NULL ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, toxic LIMIT {FIT_ROWS}) l
      JOIN documents d USING (doc_id) WHERE d.text IS NOT NULL),
pre AS (SELECT DISTINCT doc_id, text, toxic, v[1:k] AS stem FROM (SELECT doc_id, text, toxic, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS v FROM fit), range({STEM_LENGTHS.start}, {STEM_LENGTHS.stop}) ks(k) WHERE length(v) >= k),
total AS (SELECT count(*) FILTER (toxic = 1) AS nt, count(*) FILTER (toxic <> 1) AS nc FROM fit),
stems AS (SELECT stem FROM (SELECT stem, count(*) FILTER (toxic = 1) AS t, count(*) FILTER (toxic <> 1) AS c FROM pre GROUP BY 1), total
      WHERE t >= {STEM_LEAST} AND {STEM_SHARE} * t >= nt AND nc > 0 AND t * nc > {STEM_RATIO} * (c + 1) * nt),
s AS (SELECT r, count(*) AS n_stems FROM (SELECT r, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS v FROM t)
      WHERE {" OR ".join(f"length(v) >= {k} AND v[1:{k}] IN (SELECT stem FROM stems)" for k in STEM_LENGTHS)} GROUP BY r),
x AS (SELECT w.doc_id, coalesce(n_stems, 0) AS n_stems, CAST(len(words) AS BIGINT) AS n_words,
      CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
      len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
      length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
      len(list_filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z_]+'),
          lambda x: x IN ({", ".join(f"'{t}'" for t in TOXIC_TERMS)}))) AS n_toxic
      FROM w LEFT JOIN m USING (r) LEFT JOIN s USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT ({" OR ".join(f"({rule})" for _, rule in RULES)}) AS kept
FROM x
"""
