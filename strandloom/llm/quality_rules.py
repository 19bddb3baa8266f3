"""Quality rules as weak supervision, with DataFrame functions only.

Every rule votes good (1), votes bad (-1) or abstains (0). Documents are counted by their vector of votes, of which there
are at most 3 ** rules whatever the corpus' size; expectation-maximisation over these counts estimates how each rule votes on
good and on bad documents, and so its accuracy, and the share of good documents. The posterior probability of being good
replaces "all rules must pass". That a rule abstains counts as well, so a rare kind of junk that rules for good documents
pass over is not outweighed by a large share of good documents.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import SPACE, written

#: What makes each rule vote -1 or 1, in integer arithmetic that every SQL engine does alike.
RULES = {
    "symbols": ("n_words > 0 and 10 * n_symbols >= n_words", "false"),
    "lines": ("n_lines >= 3 and 10 * n_dup_lines >= 4 * n_lines", "false"),
    "long_words": ("n_words > 0 and word_chars >= 13 * n_words", "false"),
    "short_words": ("n_words > 0 and word_chars < 2 * n_words", "false"),
    "shouting": ("word_chars > 0 and 5 * n_upper >= 2 * word_chars", "false"),
    "monotony": ("n_words >= 50 and n_distinct * n_distinct <= 4 * n_words", "false"),
    "prose": ("false", "n_words >= 10 and 50 * n_symbols <= n_words and 7 * n_upper <= word_chars and 20 * n_repeat_words <= n_words and (n_words < 50 or n_distinct * n_distinct > 4 * n_words)"),
    "words": ("false", "n_words >= 10 and word_chars between 3 * n_words and 9 * n_words and 10 * n_symbols < n_words and 5 * n_upper < 2 * word_chars and 5 * n_repeat_words <= n_words and (n_words < 50 or n_distinct * n_distinct > 4 * n_words)"),
}
#: The accuracy that votes start with, and rounds.
START, ROUNDS = 0.95, 25
#: Chances of the votes -1, 0, 1 of good documents, and of bad ones, that estimates lean to, and the documents these count as.
LEAN, WEIGHT = (0.02, 0.49, 0.49, 0.49, 0.49, 0.02), 2.0
_FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_distinct")


def features(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_distinct (long). Null: empty.

    The columns come after those of docs, under the prefix _f_.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("_words", F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != ""))
    df = df.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    # one number for each window of five words: equal windows are equal numbers, and unequal ones are told apart below
    df = df.withColumn(
        "_windows",
        F.expr("if(size(_hash) < 5, array(), transform(sequence(0, greatest(size(_hash) - 5, 0)), i -> xxhash64(_hash[i], _hash[i + 1], _hash[i + 2], _hash[i + 3], _hash[i + 4])))"),
    )
    df = df.withColumn("_repeats", F.expr("size(array_distinct(_windows)) < size(_windows)"))
    # only texts with a repeated number sort their windows: the starts of those that equal a neighbour, in order
    df = df.withColumn(
        "_sorted",
        F.expr("if(_repeats, array_sort(transform(sequence(0, size(_words) - 5), i -> named_struct('w', concat_ws(' ', slice(_words, i + 1, 5)), 'i', i))), array())"),
    )
    df = df.withColumn(
        "_starts",
        F.expr("array_sort(filter(transform(_sorted, (x, k) -> if((k > 0 and _sorted[greatest(k - 1, 0)].w = x.w) or (k < size(_sorted) - 1 and _sorted[least(k + 1, size(_sorted) - 1)].w = x.w), x.i, -1)), i -> i >= 0))"),
    )
    df = df.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")))
    named = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        # each start covers five words, less those that the next start covers too
        "n_repeat_words": F.expr("aggregate(transform(_starts, (s, k) -> if(k < size(_starts) - 1, least(5, _starts[least(k + 1, size(_starts) - 1)] - s), 5)), 0, (a, x) -> a + x)"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_distinct": F.size(F.array_distinct("_hash")),
    }
    df = df.withColumns({f"_f_{k}": v.cast("long") for k, v in named.items()})
    return df.drop("_words", "_hash", "_windows", "_repeats", "_sorted", "_starts", "_lines")


def _vote(rule: str, prefix: str = "") -> str:
    """SQL of a rule's vote over the features' columns."""
    bad, good = RULES[rule]
    out = f"case when {bad} then -1 when {good} then 1 else 0 end"
    return re.sub(rf"\b({'|'.join(_FEATURES)})\b", rf"{prefix}\1", out)


def votes() -> Column:
    """Array of the rules' votes."""
    return F.expr(f"array({', '.join(_vote(r, '_f_') for r in RULES)})")


def estimate(counts: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """By rule the chances of its votes -1, 0, 1 of good documents and of bad ones, then the share of good documents.

    counts: v (votes), n (documents with them). All rounds run inside one SQL expression over one row, whose array has at
    most 3 ** rules entries.
    """
    k = len(RULES)
    chance = lambda shift, share: f"aggregate(transform(p.v, (v, j) -> s[6 * j + v + {shift}]), {share}, (x, y) -> x * y)"
    good, bad = chance(1, f"s[{6 * k}]"), chance(4, f"1 - s[{6 * k}]")
    posterior = f"transform(patterns, p -> named_struct('v', p.v, 'n', p.n, 'g', ({good}) / (({good}) + ({bad}))))"
    mass = "r.n * if(i % 6 < 3, r.g, 1 - r.g)"
    lean = f"array({', '.join(f'{x * WEIGHT}D' for x in LEAN)})"
    voted = f"{lean}[i % 6] + aggregate(post, 0D, (x, r) -> x + if(r.v[cast(floor(i / 6) as int)] = i % 3 - 1, {mass}, 0D))"
    share = f"aggregate(post, {WEIGHT / 2}D, (x, r) -> x + r.n * r.g) / aggregate(post, {WEIGHT}D, (x, r) -> x + r.n)"
    step = f"concat(transform(sequence(0, {6 * k - 1}), i -> ({voted}) / aggregate(post, {WEIGHT}D, (x, r) -> x + {mass})), array({share}))"
    start = f"concat(flatten(array_repeat(array({1 - START}D, 1D, {START}D, {START}D, 1D, {1 - START}D), {k})), array(0.5D))"
    em = f"aggregate(sequence(1, {rounds}), {start}, (s, i) -> transform(array({posterior}), post -> {step})[0])"
    return list(counts.agg(F.array_sort(F.collect_list(F.struct("v", F.col("n").cast("double").alias("n")))).alias("patterns")).select(F.expr(em).alias("s")).first().s)


def judged(docs: DataFrame, keep: list[str], threshold: float = 0.5) -> DataFrame:
    """_in (the columns to keep of docs), _f_ features, _base_failed, _probability (posterior of being good) and _kept.

    _base_failed: under 10 words, or more than 20 % of the words in repeated 5-word windows. _kept: not _base_failed and
    a posterior of at least the threshold. Null and empty texts have no words and fail. Rows that repeat are judged alike;
    an empty table gives an empty table; a posterior of exactly the threshold is kept. The chances of votes and the share
    of good documents are fitted to all documents that pass the base check. The features are written once in the shared folder and read for both passes.
    """
    failed = (F.col("_f_n_words") < 10) | (100 * F.col("_f_n_repeat_words") > 20 * F.col("_f_n_words"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_in"), "text")
    scored = written(features(rows).drop("text").withColumn("_v", votes()).withColumn("_base_failed", failed))
    *chances, share = estimate(scored.where("not _base_failed").groupBy(F.col("_v").alias("v")).agg(F.count("*").alias("n")))
    good, bad = F.lit(share), F.lit(1 - share)
    for j in range(len(RULES)):
        vote = F.col("_v")[j]
        of = lambda p: F.when(vote == -1, F.lit(p[0])).when(vote == 0, F.lit(p[1])).otherwise(F.lit(p[2]))
        good, bad = good * of(chances[6 * j : 6 * j + 3]), bad * of(chances[6 * j + 3 : 6 * j + 6])
    out = scored.withColumn("_probability", good / (good + bad)).drop("_v")
    return out.withColumn("_kept", ~F.col("_base_failed") & (F.col("_probability") >= threshold))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row; see judged."""
    out = judged(docs, ["doc_id"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("_in.doc_id", *(F.col(f"_f_{c}").alias(c) for c in names), F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with docs' columns."""
    return judged(docs, docs.columns).where("_kept").select("_in.*")


def oracle(documents: str = "documents") -> str:
    """DuckDB SQL for quality()."""
    k = len(RULES)
    cases = ", ".join(f"{_vote(r)} as v{j}" for j, r in enumerate(RULES))
    vs = ", ".join(f"v{j}" for j in range(k))
    of = lambda j, c: f"(case v{j} when -1 then a{j}_{c} when 0 then a{j}_{c + 1} else a{j}_{c + 2} end)"
    good, bad = ("b * " + " * ".join(of(j, 0) for j in range(k)), "(1 - b) * " + " * ".join(of(j, 3) for j in range(k)))
    first = (1 - START, 1, START, START, 1, 1 - START)
    rounds = ["par0 as (select " + ", ".join(f"{x}::double as a{j}_{c}" for j in range(k) for c, x in enumerate(first)) + ", 0.5::double as b)"]
    for t in range(ROUNDS + 1):
        rounds.append(f"post{t} as materialized (select {', '.join('p.' + v for v in vs.split(', '))}, n, {good} / ({good} + {bad}) as g from pat p, par{t})")
        mass = ("n * g", "n * (1 - g)")
        each = ", ".join(f"({x * WEIGHT} + coalesce(sum({mass[c // 3]}) filter (v{j} = {c % 3 - 1}), 0)) / ({WEIGHT} + coalesce(sum({mass[c // 3]}), 0)) as a{j}_{c}" for j in range(k) for c, x in enumerate(LEAN))
        rounds.append(f"par{t + 1} as materialized (select {each}, ({WEIGHT / 2} + coalesce(sum(n * g), 0)) / ({WEIGHT} + coalesce(sum(n), 0)) as b from post{t})")
    return f"""
with base as (select doc_id, coalesce(text, '') as text, row_number() over () as r from {documents}),
words as (select r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from base),
win as (select r, i, array_to_string(w[i:i + 4], ' ') as g from (select r, w, unnest(range(1, len(w) - 3)) as i from words where len(w) >= 5)),
dup as (select r, i from (select r, i, count(*) over (partition by r, g) as c from win) where c > 1),
cover as (select r, count(distinct i + o) as n from dup, (select unnest(range(0, 5)) as o) group by r),
feat as (select words.r, doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(ls)::bigint as n_lines,
  (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(cover.n, 0)::bigint as n_repeat_words,
  len(regexp_extract_all(text, '\\p{{Lu}}'))::bigint as n_upper, len(list_distinct(w))::bigint as n_distinct
  from words left join cover using (r)),
vote as (select *, {cases}, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed from feat),
pat as materialized (select {vs}, count(*)::double as n from vote where not base_failed group by all),
{", ".join(rounds[:-1])}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  base_failed, not base_failed and coalesce(g, 1) >= 0.5 as kept
from vote left join post{ROUNDS} using ({vs})
"""
