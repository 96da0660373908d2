"""Documents as token streams: vocabularies, encoding, offsets, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import whole_div
from ..operators import tokens as tk
from ..operators import windows as wn
from .registry import CTX, SQL_TOKENS, joined, query, sql_flat, table

TEXT_TABLE = "documents"


def documents(spark, folder, where: str = "true"):
    return table(spark, folder, TEXT_TABLE).where(where).select("doc_id", "text")


def offsets(spark, folder, where: str = "true"):
    """(doc_id, n_tokens, item, start, pointer) under the byte vocabulary."""
    sizes = documents(spark, folder, where).select(
        "doc_id", tk.byte_token_count(F.col("text")).alias("n_tokens")
    )
    return tk.stream_offsets(sizes, ["doc_id"])


def stream(spark, folder, where: str = "true"):
    """(doc_id, start, tokens): ids are made after the join, so texts travel and not arrays; the pieces
    that windows shuffle have 16 bits a token."""
    placed = offsets(spark, folder, where).select("doc_id", "start")
    return (
        documents(spark, folder, where)
        .join(placed, "doc_id")
        .select("doc_id", "start", tk.narrow_byte_tokens("text").alias("tokens"))
    )


@query("""SELECT CAST(row_number() OVER (ORDER BY ch) - 1 AS INTEGER) AS id, ch
FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents)""")
def char_vocab(spark, folder):
    return tk.char_vocab(documents(spark, folder))


SQL_CHARS = """vocab AS (SELECT row_number() OVER (ORDER BY ch) - 1 AS id, ch
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents)),
chars AS (SELECT doc_id, unnest(string_split(text, '')) AS ch,
  generate_subscripts(string_split(text, ''), 1) AS place FROM documents)"""


def _char_ids(spark, folder):
    docs = documents(spark, folder)
    vocab = tk.vocab_list(tk.char_vocab(docs))
    return docs.select("doc_id", "text", tk.char_tokens(F.col("text"), vocab).alias("tokens")), vocab


@query(f"""WITH {SQL_CHARS} SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY place) AS tokens
FROM chars JOIN vocab USING (ch) GROUP BY doc_id""")
def char_tokens(spark, folder):
    ids, _ = _char_ids(spark, folder)
    return ids.select("doc_id", joined("tokens").alias("tokens"))


@query("SELECT doc_id, text AS decoded FROM documents")
def decode_corpus(spark, folder):
    ids, vocab = _char_ids(spark, folder)
    return ids.select("doc_id", tk.char_decode(F.col("tokens"), vocab).alias("decoded"))


@query(f"""WITH {SQL_TOKENS} SELECT doc_id, array_to_string(ids, ' ') AS tokens FROM tok""")
def tokenize_bytes(spark, folder):
    docs = documents(spark, folder)
    return docs.select("doc_id", joined(tk.byte_tokens("text")).alias("tokens"))


# A written-out vocabulary behind the single bytes. Many entries begin others, so that only a
# longest match reads the texts as the SQL does.
WORDS = (
    "a", "an", "and", "andth", "ch", "der", "die", "e", "en", "ent", "er", "erst", "es", "ha",
    "he", "in", "ing", "ion", "it", "la", "ment", "ou", "que", "re", "sch", "schen", "st", "t",
    "th", "that", "the", "then", "there", "thereth", "ti", "tion", "ver", " a", " an", " and",
    " d", " der", " en", " in", " th", " the", " thee", ". ", ".\n", ", ",
)
_LONGEST_FIRST = sorted(WORDS, key=lambda w: (-len(w), w))
_SQL_WORDS = "[" + ", ".join("'" + w.replace("\n", "' || chr(10) || '") + "'" for w in WORDS) + "]"
_SQL_MATCH = "|".join(w.replace(".", "[.]").replace("\n", "\\n") for w in _LONGEST_FIRST)
SQL_GREEDY = f"""greedy AS (SELECT doc_id, list_concat(flatten(list_transform(
    regexp_extract_all(text, '(?s){_SQL_MATCH}|.'),
    lambda m: CASE WHEN list_contains({_SQL_WORDS}, m) THEN [256 + list_position({_SQL_WORDS}, m)]
      ELSE list_transform(regexp_extract_all(hex(encode(m)), '..'), lambda h: CAST('0x' || h AS INTEGER) + 1) END)), [0]) AS ids
  FROM documents)"""


def word_vocabulary() -> dict[bytes, int]:
    """All single bytes, then :data:`WORDS` that are more than a byte, by their place in it."""
    vocabulary = tk.byte_vocabulary()
    for place, word in enumerate(WORDS):
        vocabulary[word.encode()] = 257 + place
    return vocabulary


@query(f"WITH {SQL_GREEDY} SELECT doc_id, array_to_string(ids, ' ') AS tokens FROM greedy")
def tokenize_corpus(spark, folder):
    """Ids under a vocabulary of bytes and words, greedy longest match."""
    encode = tk.tokenizer(word_vocabulary())
    ids = documents(spark, folder).select("doc_id", encode("text").alias("tokens"))
    return ids.select("doc_id", joined("tokens").alias("tokens"))


@query("SELECT doc_id, md5(text) AS back FROM documents")
def tokenize_round_trip(spark, folder):
    vocabulary = word_vocabulary()
    encode, decode = tk.tokenizer(vocabulary), tk.decoder(vocabulary)
    ids = documents(spark, folder).select("doc_id", encode("text").alias("tokens"))
    return ids.select("doc_id", F.md5(decode("tokens")).alias("back"))


@query("""WITH s AS (SELECT doc_id, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS n_tokens FROM documents)
SELECT doc_id, n_tokens, row_number() OVER (ORDER BY doc_id) - 1 AS item,
  CAST(sum(n_tokens) OVER (ORDER BY doc_id) - n_tokens AS BIGINT) AS start,
  CAST((sum(n_tokens) OVER (ORDER BY doc_id) - n_tokens) * 2 AS BIGINT) AS pointer FROM s""")
def stream_offsets(spark, folder):
    return offsets(spark, folder)


@query(f"""WITH {SQL_TOKENS} SELECT count(*) AS n_items, CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
  CAST(sum(len(ids)) * 2 AS BIGINT) AS n_bytes, min(len(ids)) AS min_size, max(len(ids)) AS max_size,
  bool_and(ids[-1] = 0) AS all_ended FROM tok""")
def stream_totals(spark, folder):
    return tk.stream_totals(documents(spark, folder).select(tk.byte_tokens("text").alias("tokens")))


@query("""WITH e AS (SELECT 'first' AS document, arg_min(text, doc_id) AS text FROM documents
UNION ALL SELECT 'last', arg_max(text, doc_id) FROM documents)
SELECT document, left(text, 100) AS head, right(text, 100) AS tail FROM e""")
def stream_preview(spark, folder):
    return tk.stream_preview(documents(spark, folder), "doc_id")


@query(f"""WITH {SQL_TOKENS}, p AS (SELECT doc_id, ids, len(ids) // 4 AS off, len(ids) // 2 AS n FROM tok)
SELECT doc_id, array_to_string(ids[off + 1 : off + n], ' ') AS part, array_to_string(ids[off + 1 :], ' ') AS rest FROM p""")
def token_span_get(spark, folder):
    ids = documents(spark, folder).select("doc_id", tk.byte_tokens("text").alias("tokens"))
    offset, length = whole_div(F.size("tokens"), 4), whole_div(F.size("tokens"), 2)
    return ids.select(
        "doc_id",
        joined(tk.item_span(F.col("tokens"), offset, length)).alias("part"),
        joined(tk.item_span(F.col("tokens"), offset)).alias("rest"),
    )


@query(f"""WITH {SQL_TOKENS}, {sql_flat('flat')},
w AS (SELECT pos, id, lead(id) OVER (ORDER BY pos) AS nxt FROM flat)
SELECT pos // {CTX} AS window_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS x,
  string_agg(CAST(nxt AS VARCHAR), ' ' ORDER BY pos) AS y
FROM w GROUP BY 1 HAVING count(nxt) = {CTX}""")
def pack_windows(spark, folder):
    packed = wn.inputs_and_targets(wn.pack_windows(stream(spark, folder), CTX))
    return packed.select(
        F.col("window").alias("window_id"), joined("x").alias("x"), joined("y").alias("y")
    )


@query(f"""WITH {SQL_TOKENS}, {sql_flat('flat')}
SELECT pos // 300 AS row_id,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos % 300 < 299) AS x,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos % 300 > 0) AS y
FROM flat GROUP BY 1 HAVING count(*) = 300""")
def fixed_rows(spark, folder):
    rows = wn.fixed_rows(stream(spark, folder), 300)
    return rows.select(F.col("window").alias("row_id"), joined("x").alias("x"), joined("y").alias("y"))


@query(f"""WITH {SQL_TOKENS}, {sql_flat('flat')},
r AS (SELECT doc_id, pos, pos - min(pos) OVER (PARTITION BY doc_id) AS place FROM flat),
k AS (SELECT *, pos // {CTX} AS window_id FROM r
  UNION ALL SELECT *, pos // {CTX} - 1 FROM r WHERE pos % {CTX} = 0 AND pos > 0)
SELECT window_id, doc_id, min(place) AS first, count(*) AS n FROM k GROUP BY 1, 2""")
def window_to_docs(spark, folder):
    return wn.documents_in_windows(offsets(spark, folder), CTX).withColumnRenamed("window", "window_id")


MASK_CTX = 128
PATTERN_TEXT = "tion"
PATTERN = [b + 1 for b in PATTERN_TEXT.encode()]


@query(f"""WITH {SQL_TOKENS}, {sql_flat('main', "lang = 'en'")}, {sql_flat('back', "lang <> 'en'")},
w AS (SELECT pos // {MASK_CTX} AS window_id, pos % {MASK_CTX} AS i, pos, id, lead(id) OVER (ORDER BY pos) AS nxt,
  lag(id, 1) OVER (ORDER BY pos) AS b1, lag(id, 2) OVER (ORDER BY pos) AS b2, lag(id, 3) OVER (ORDER BY pos) AS b3 FROM main),
full_w AS (SELECT window_id FROM w GROUP BY 1 HAVING count(nxt) = {MASK_CTX}),
ev AS (SELECT w.*, CASE WHEN i >= 3 AND id = 0 THEN 0
  WHEN i >= 3 AND id = {PATTERN[3]} AND b1 = {PATTERN[2]} AND b2 = {PATTERN[1]} AND b3 = {PATTERN[0]} THEN 1 END AS e
  FROM w JOIN full_w USING (window_id)),
z AS (SELECT window_id, i, pos, id, nxt, coalesce(last_value(e IGNORE NULLS) OVER (PARTITION BY window_id ORDER BY i), 0) AS z FROM ev),
s AS (SELECT window_id, max(z) AS any_z FROM z GROUP BY 1),
n AS (SELECT count(*) AS total FROM back),
draw AS (SELECT window_id, CAST('0x' || substr(md5('5:' || window_id), 1, 15) AS BIGINT) % (total - {MASK_CTX} - 1) AS start
  FROM s, n WHERE any_z = 0),
spans AS (SELECT window_id, start + unnest(range({MASK_CTX})) AS pos FROM draw),
nb AS (SELECT pos, id, lead(id) OVER (ORDER BY pos) AS nxt FROM back),
out AS (SELECT z.window_id, false AS replaced, pos, id, nxt, z FROM z JOIN s USING (window_id) WHERE any_z = 1
  UNION ALL SELECT window_id, true, pos, id, nxt, 1 FROM spans JOIN nb USING (pos))
SELECT window_id, replaced, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS x,
  string_agg(CAST(nxt AS VARCHAR), ' ' ORDER BY pos) AS y, string_agg(CAST(z AS VARCHAR), ' ' ORDER BY pos) AS z
FROM out GROUP BY 1, 2""")
def answer_span_mask(spark, folder):
    samples = wn.pack_windows(stream(spark, folder, "lang = 'en'"), MASK_CTX)
    other = "lang <> 'en'"
    size = documents(spark, folder, other).agg(F.sum(tk.byte_token_count(F.col("text")))).first()[0]
    masked = wn.masked_samples(samples, stream(spark, folder, other), size, MASK_CTX, PATTERN, seed=5)
    return wn.inputs_and_targets(masked).select(
        F.col("window").alias("window_id"),
        "replaced",
        *[joined(c).alias(c) for c in ("x", "y", "z")],
    )


@query(f"""WITH {SQL_TOKENS}, n AS (SELECT doc_id, ids, row_number() OVER (ORDER BY doc_id) - 1 AS item FROM tok)
SELECT item, array_to_string(ids, ' ') AS tokens FROM n WHERE item BETWEEN 10 AND 20""")
def item_range(spark, folder):
    """Eleven consecutive items of the stream: the feature is the range."""
    placed = offsets(spark, folder).select("doc_id", "item")
    wanted = tk.item_range(placed, 10, 20)
    rows = documents(spark, folder).join(wanted, "doc_id")
    return rows.select("item", joined(tk.byte_tokens("text")).alias("tokens"))
