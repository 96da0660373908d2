"""Epoch orders, sampling plans and the samples they read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import uniform_below
from ..functions.numbers import sampler_prime, whole_div
from ..operators import joins, sampling
from ..operators import tokens as tk
from ..operators import windows as wn
from ..session import scratch_path
from ..sources.text import read_mixture
from .registry import CTX, SQL_TOKENS, joined, query, sql_flat, table
from .streams import PATTERN, documents, stream


def documents_with_source(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "source", "text")


def _total(spark, folder, where="true") -> int:
    size = F.sum(tk.byte_token_count(F.col("text")))
    return documents(spark, folder, where).agg(size).first()[0]


# The modulus, found from the size of the stream, and the factor made from it.
SQL_PRIME = f"""sz AS (SELECT CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS total FROM documents),
bg AS (SELECT CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS total FROM documents WHERE lang <> 'en'),
cand AS (SELECT unnest(range(2, total // {CTX})) AS c FROM sz),
pr AS (SELECT max(c) AS p FROM cand WHERE c % 3 = 2
  AND NOT EXISTS (SELECT 1 FROM cand d WHERE d.c * d.c <= cand.c AND cand.c % d.c = 0)),
pf AS (SELECT p, CAST(floor(p * ((sqrt(5.0::DOUBLE) - 1) / 2)) AS HUGEINT) AS f FROM pr)"""


def sql_cubic(ii: str) -> str:
    return f"CAST(((((f * {ii}) % p) * {ii}) % p * {ii}) % p * {CTX} AS BIGINT)"


def sql_draw(seed: int, number: str, total: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {number}), 1, 15) AS BIGINT) % ({total} - {CTX} - 1)"


@query("""WITH c AS (SELECT epoch, doc_id FROM documents, range(3) t(epoch))
SELECT CAST(epoch AS INTEGER) AS epoch, doc_id, row_number() OVER (PARTITION BY epoch
  ORDER BY md5('11:' || epoch || ':' || doc_id), doc_id) - 1 AS position FROM c""")
def epoch_shuffle(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return sampling.epoch_shuffle(docs, "doc_id", 3, seed=11)


@query(f"""WITH {SQL_PRIME}, n AS (SELECT unnest(range(1, p)) AS ii FROM pf)
SELECT (ii - 1) // 40320 AS epoch, (ii - 1) % 40320 // 4 AS idx, (ii - 1) % 40320 % 4 AS rank, ii,
  {sql_cubic('ii')} AS start FROM n, pf""")
def cubic_sample_plan(spark, folder):
    total = _total(spark, folder)
    prime = sampler_prime(total, CTX)
    sampling.check_plan(prime, total, CTX)
    numbers = sampling.sample_numbers(spark, prime - 1, world=4)
    return sampling.sample_starts(numbers, prime, total, CTX)


@query(f"""WITH {SQL_PRIME}, n AS (SELECT unnest(range(1, p)) AS ii FROM pf)
SELECT ii, CASE WHEN ii < 100 THEN {sql_draw(3, 'ii', 'total')}
  ELSE (CAST(((((f * (ii - 100)) % p) * (ii - 100)) % p * (ii - 100)) % p * {CTX} AS BIGINT)) + 7 END AS start
FROM n, pf, sz""")
def random_sample_plan(spark, folder):
    total = _total(spark, folder)
    prime = sampler_prime(total, CTX)
    sampling.check_plan(prime, total, CTX)
    numbers = sampling.sample_numbers(spark, prime - 1)
    plan = sampling.sample_starts(numbers, prime, total, CTX, shift=7, random_steps=100, seed=3)
    return plan.select("ii", "start")


@query(f"""WITH {SQL_PRIME}, n AS (SELECT unnest(range(1, p)) AS ii FROM pf)
SELECT ii, CASE WHEN ii % 2 = 0 THEN 'background' ELSE 'main' END AS corpus,
  CASE WHEN ii % 2 = 0 THEN {sql_draw(4, 'ii', 'bg.total')} ELSE {sql_cubic('(ii // 2)')} END AS start
FROM n, pf, bg""")
def interleave_sources(spark, folder):
    prime = sampler_prime(_total(spark, folder), CTX)
    background = _total(spark, folder, "lang <> 'en'")
    numbers = sampling.sample_numbers(spark, prime - 1)
    plan = sampling.interleaved_starts(numbers, prime, CTX, background, seed=4)
    return plan.select("ii", "corpus", "start")


@query(f"""WITH {SQL_TOKENS}, {sql_flat('flat')}, {SQL_PRIME}, n AS (SELECT unnest(range(1, p)) AS ii FROM pf),
plan AS (SELECT ii, {sql_cubic('ii')} AS start FROM n, pf),
w AS (SELECT pos // {CTX} AS block, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS x FROM flat GROUP BY 1)
SELECT ii, start, x FROM plan JOIN w ON start // {CTX} = block""")
def training_samples(spark, folder):
    total = _total(spark, folder)
    prime = sampler_prime(total, CTX)
    plan = sampling.sample_starts(
        sampling.sample_numbers(spark, prime - 1), prime, total, CTX
    ).select("ii", "start")
    packed = wn.inputs_and_targets(wn.pack_windows(stream(spark, folder), CTX))
    return wn.read_blocks(plan, packed, CTX).select("ii", "start", joined("x").alias("x"))


@query(f"""WITH {SQL_TOKENS}, {sql_flat('flat')}, {SQL_PRIME},
plan AS (SELECT doc_id AS ii, {sql_draw(9, 'doc_id', 'total')} AS start FROM documents, sz),
need AS (SELECT ii, start, start + unnest(range({CTX} + 1)) AS pos FROM plan)
SELECT ii, start, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS tokens
FROM need JOIN flat USING (pos) GROUP BY 1, 2""")
def random_training_samples(spark, folder):
    """One window at a random place of the stream for every document number."""
    total = _total(spark, folder)
    plan = table(spark, folder, "documents").select(
        F.col("doc_id").alias("ii"),
        sampling.random_start(F.col("doc_id"), total, CTX, seed=9).alias("start"),
    )
    spans = wn.read_spans(plan, stream(spark, folder), CTX)
    return spans.select("ii", "start", joined("tokens").alias("tokens"))


@query("""WITH m AS (SELECT source AS part, count(*) AS cnt FROM documents GROUP BY 1),
c AS (SELECT part, cnt, CAST(sum(cnt * 3) OVER (ORDER BY part) AS BIGINT) AS cutoff FROM m),
t AS (SELECT max(cutoff) AS total FROM c),
p AS (SELECT doc_id, CAST('0x' || substr(md5('6:' || doc_id), 1, 15) AS BIGINT) % total AS position FROM documents, t)
SELECT doc_id, position, part, (position - (cutoff - cnt * 3)) % cnt AS local_position
FROM p JOIN c ON position >= cutoff - cnt * 3 AND position < cutoff""")
def mixture_route(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    parts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    mixture = joins.mixture_table(parts.withColumn("width", F.col("n") * 3), "source", "n", "width")
    total = mixture.agg(F.max("cutoff")).first()[0]
    positions = docs.select(
        "doc_id", uniform_below(F.lit(total), 6, F.col("doc_id")).alias("position")
    )
    return joins.route_to_mixture(positions, mixture, "doc_id", "position")


@query(f"""WITH {SQL_TOKENS}, {sql_flat('flat')}, {sql_flat('back', "lang <> 'en'")}, {SQL_PRIME},
n AS (SELECT unnest(range(1, p)) AS ii FROM pf),
plan AS (SELECT ii, ii % 2 = 0 AS even,
  CASE WHEN ii % 2 = 0 THEN {sql_draw(4, 'ii', 'bg.total')} ELSE {sql_cubic('(ii // 2)')} END AS start FROM n, pf, bg),
need AS (SELECT ii, even, start, unnest(range({CTX} + 1)) AS i FROM plan),
got AS (SELECT ii, i, id FROM need JOIN back ON even AND pos = start + i
  UNION ALL SELECT ii, i, id FROM need JOIN flat ON NOT even AND pos = start + i),
ev AS (SELECT *, lag(id, 1) OVER w AS b1, lag(id, 2) OVER w AS b2, lag(id, 3) OVER w AS b3 FROM got
  WINDOW w AS (PARTITION BY ii ORDER BY i)),
z AS (SELECT ii, i, CASE WHEN ii % 2 = 0 THEN 1 ELSE coalesce(last_value(CASE WHEN i >= 3 AND id = 0 THEN 0
  WHEN i >= 3 AND id = {PATTERN[3]} AND b1 = {PATTERN[2]} AND b2 = {PATTERN[1]} AND b3 = {PATTERN[0]} THEN 1 END IGNORE NULLS)
  OVER (PARTITION BY ii ORDER BY i), 0) END AS z FROM ev WHERE i < {CTX}),
zs AS (SELECT ii, string_agg(CAST(z AS VARCHAR), ' ' ORDER BY i) AS z FROM z GROUP BY 1),
xs AS (SELECT ii, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i) FILTER (WHERE i < {CTX}) AS x,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i) FILTER (WHERE i > 0) AS y FROM got GROUP BY 1)
SELECT ii, CASE WHEN ii % 2 = 0 THEN 'background' ELSE 'main' END AS corpus, x, y, z FROM xs JOIN zs USING (ii)""")
def interleaved_samples(spark, folder):
    """Even samples from a random place of the background, odd ones from the main corpus, masked."""
    total, other = _total(spark, folder), "lang <> 'en'"
    prime = sampler_prime(total, CTX)
    sampling.check_plan(prime, total, CTX)
    plan = sampling.interleaved_starts(
        sampling.sample_numbers(spark, prime - 1), prime, CTX, _total(spark, folder, other), seed=4
    ).select("ii", "corpus", "start")
    main = wn.pack_windows(stream(spark, folder), CTX)
    background = stream(spark, folder, other)
    samples = wn.interleaved_samples(plan, main, background, CTX, PATTERN)
    return samples.select("ii", "corpus", *[joined(c).alias(c) for c in ("x", "y", "z")])


@query(f"""WITH {SQL_TOKENS}, {sql_flat('flat')}, m AS (SELECT source AS part, sum(len(ids)) AS cnt
  FROM tok JOIN (SELECT doc_id, source FROM documents) USING (doc_id) GROUP BY 1),
c AS (SELECT part, cnt, CAST(sum(cnt) OVER (ORDER BY part) AS BIGINT) AS cutoff FROM m),
t AS (SELECT max(cutoff) AS total FROM c),
p AS (SELECT doc_id, CAST('0x' || substr(md5('7:' || doc_id), 1, 15) AS BIGINT) % total AS position FROM documents, t),
s AS (SELECT source, doc_id, id, row_number() OVER (PARTITION BY source ORDER BY pos) - 1 AS at
  FROM flat JOIN (SELECT doc_id, source FROM documents) USING (doc_id))
SELECT p.doc_id, part, s.id AS token FROM p JOIN c ON position >= cutoff - cnt AND position < cutoff
JOIN s ON s.source = part AND s.at = position - (cutoff - cnt)""")
def mixture_tokens(spark, folder):
    """Positions routed by a written list file, and the token that each sub-dataset holds there."""
    docs = documents_with_source(spark, folder)
    sizes = docs.select("doc_id", "source", tk.byte_token_count(F.col("text")).alias("n"))
    parts = sizes.groupBy("source").agg(F.sum("n").alias("n"))
    path = scratch_path(spark, "mixture")
    made = joins.mixture_table(parts, "source", "n", "n")
    made.select(F.concat_ws(" ", "part", "count", "cutoff").alias("value")).write.text(path)
    mixture = read_mixture(spark, path)
    total = mixture.agg(F.max("cutoff")).first()[0]
    positions = docs.select("doc_id", uniform_below(F.lit(total), 7, F.col("doc_id")).alias("position"))
    routed = joins.route_to_mixture(positions, mixture, "doc_id")
    # A sub-dataset's tokens lie where its documents lie in the order of source and id.
    placed = tk.stream_offsets(sizes, ["source", "doc_id"], "n").select("doc_id", "start")
    ids = docs.select("doc_id", "text").join(placed, "doc_id")
    flat = ids.select("start", tk.narrow_byte_tokens("text").alias("tokens"))
    plan = routed.join(mixture.select("part", "prev"), "part").select(
        "doc_id", "part", (F.col("prev") + F.col("local_position")).alias("start")
    )
    blocks = wn.pack_windows(flat, CTX, extra=0, keep_tail=True)
    at = plan.withColumn("window", whole_div(F.col("start"), CTX)).join(blocks, "window")
    token = F.get("tokens", (F.col("start") % CTX).cast("int"))
    return at.select("doc_id", "part", token.cast("int").alias("token"))
