"""Vocabulary learning and token arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions import arrays, bpe
from turnloom.functions.joins import with_key_stats
from turnloom.operators import chat, diagnostics, manifest, tokens, vocab, wordcoding
from turnloom.operators.toolcalls import literal_table
from turnloom.plans import tables as t
from turnloom.plans.chats import TURN_SQL
from turnloom.session import spread
from turnloom.plans.sqltext import draw, quoted

# RE2 has no look-ahead.  A mark is put before the last white space of a run that
# is followed by text; no word may cross it, which splits runs where the
# look-ahead would.
_S = r"\p{Z}\x09-\x0d\x{85}"
_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}\x01]+|[{_S}]+"


def _pretokens_sql(x: str) -> str:
    return f"regexp_extract_all(regexp_replace({x}, '([{_S}])([^{_S}])', chr(1) || '\\1\\2', 'g'), {quoted(_WORDS)})"


PRETOKENS = f"words as (select word, count(*) as n from (select unnest({_pretokens_sql('text')}) as word from documents) group by word)"


def corpus_lines(spark, sf_dir):
    """Text each conversation or document gives to the vocabulary corpus.

    A conversation's texts are joined by newlines; it comes as one piece per turn
    that has text, each but the first with its newline in front.
    """
    turns = t.conversations(spark, sf_dir).where(F.col("text") != "")
    first = turns.groupBy("conv_id").agg(F.min("turn").alias("first"), F.count("*").alias("n"))
    joined = with_key_stats(turns, first, "conv_id", "n")
    lines = joined.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("row_id"), F.col("turn").cast("bigint").alias("piece"),
        F.concat(F.when(F.col("turn") > F.col("first"), "\n").otherwise(""), F.col("text")).alias("text"),
    )
    none = F.lit(None).cast("array<struct<content:string>>")
    docs = t.documents(spark, sf_dir).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("row_id"), F.lit(0).cast("bigint").alias("piece"), vocab.corpus_text(none, F.col("text")).alias("text")
    )
    return lines.unionByName(docs.where(F.col("text").isNotNull()))


CORPUS_LINES = """select 'c' || conv_id as row_id, cast(turn as bigint) as piece,
    case when row_number() over (partition by conv_id order by turn) > 1 then chr(10) else '' end || text as text from conversations where text <> ''
  union all select 'd' || doc_id, 0, text from documents where text <> ''"""


def pretoken_counts(spark, sf_dir):
    return vocab.pretoken_counts(spread(t.documents(spark, sf_dir)))


PRETOKEN_COUNTS = f"with {PRETOKENS} select word, n from words"


def pair_counts(spark, sf_dir):
    """Adjacent bytes inside words over the whole corpus, as two-digit hex."""
    pairs = vocab.pair_counts(vocab.pretoken_counts(spread(t.documents(spark, sf_dir))))
    chars = bpe.byte_tokens()
    lookup = F.create_map(*[F.lit(x) for c in chars for x in (c, f"{bpe.CHAR_BYTE[c]:02X}")])
    return pairs.select(F.element_at(lookup, F.col("left")).alias("left"), F.element_at(lookup, F.col("right")).alias("right"), "n")


PAIR_COUNTS = f"""with {PRETOKENS}, h as (select hex(encode(word)) as h, n from words),
p as (select substr(h, cast(2 * i - 1 as bigint), 2) as l, substr(h, cast(2 * i + 1 as bigint), 2) as r, n from (select h, n, unnest(range(1, length(h) // 2)) as i from h))
select l as left, r as right, cast(sum(n) as bigint) as n from p group by l, r"""


def word_compression(spark, sf_dir):
    """Mean characters per word piece, by language."""
    rows = spread(t.documents(spark, sf_dir)).select("lang", F.length("text").alias("c"), F.size(bpe.split_pretokens(F.col("text"))).alias("k"))
    return vocab.compression(rows, F.col("c"), F.col("k"), "lang")


WORD_COMPRESSION = f"""select lang, count(*) as n_rows, round(avg(length(text)::double / len({_pretokens_sql('text')})), 6) as chars_per_token
from documents where text <> '' group by lang"""

VOCAB_SIZE = 8000


def _learned(spark, sf_dir):
    return vocab.learn_vocab(vocab.pretoken_counts(spread(t.documents(spark, sf_dir))), VOCAB_SIZE)


def bpe_vocab(spark, sf_dir):
    """A vocabulary learned from all documents, of the operator's default size."""
    return _learned(spark, sf_dir).vocab_table(spark)


def bpe_compression(spark, sf_dir):
    """Mean characters per token under the learned vocabulary, by language."""
    docs = t.documents(spark, sf_dir).select("doc_id", "lang", "text", F.length("text").alias("c"))
    rows = wordcoding.token_counts(spread(docs), ["doc_id", "lang", "c"], "text", _learned(spark, sf_dir))
    return vocab.compression(rows, F.col("c"), F.col("n_tokens"), "lang")


def bpe_pretrain_arrays(spark, sf_dir):
    """BOS, ids under the learned vocabulary cut to 512, EOS, padding; the digest is of all ids."""
    coded = wordcoding.encode_texts(spread(t.documents(spark, sf_dir)), ["doc_id"], "text", _learned(spark, sf_dir))
    rows = coded.withColumn("row", tokens.pretrain_ids(F.col("ids"), 512))
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.md5(F.array_join("ids", ",")).alias("ids_md5"),
        F.size(F.filter(tokens.pretrain_labels(F.col("row")), lambda x: x == K.IGNORE_LABEL)).cast("bigint").alias("n_ignored"),
    )


def bpe_round_trip(spark, sf_dir):
    """decode(encode(turn)) under the learned vocabulary must be the rendered turn, reserved tokens included; by role."""
    prompts = chat.render_turns(t.conversations(spark, sf_dir)).select("conv_id", "turn", F.col("role").alias("grp"), F.col("piece").alias("prompt"))
    learned, keys = _learned(spark, sf_dir), ["conv_id", "turn"]
    coded = wordcoding.encode_texts(spread(prompts), keys, "prompt", learned)
    back = prompts.join(wordcoding.decode_texts(coded, keys, learned), keys, "left")
    return back.groupBy("grp").agg(F.count("*").alias("n_rows"), F.count_if(~F.encode("prompt", "UTF-8").eqNullSafe(F.col("bytes"))).alias("n_changed"))


def byte_round_trip(spark, sf_dir):
    """decode(encode(turn)) must be the rendered turn, reserved tokens included."""
    prompts = chat.render_turns(t.conversations(spark, sf_dir)).select(F.col("role").alias("grp"), F.col("piece").alias("prompt"))
    encode, decode = bpe.encoder(), bpe.decoder()
    coded = prompts.withColumn("ids", encode(F.col("prompt")))
    return vocab.round_trip(coded, F.col("prompt"), F.col("ids"), decode, "grp")


BYTE_ROUND_TRIP = BPE_ROUND_TRIP = "select role as grp, count(*) as n_rows, cast(0 as bigint) as n_changed from conversations group by 1"


def stream_pieces(spark, sf_dir):
    """Byte tokens of whole documents, shown only once they form characters."""
    rows = spread(t.documents(spark, sf_dir)).select("doc_id", bpe.byte_ids(F.col("text")).alias("ids"))
    out = rows.select("doc_id", F.size("ids").alias("n"), bpe.streamed_pieces(F.col("ids")).alias("p"))
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_tokens"), F.size("p.text").cast("bigint").alias("n_pieces"),
                      F.md5(F.array_join("p.text", "")).alias("text_md5"))


STREAM_PIECES = "select doc_id, octet_length(encode(text)) as n_tokens, length(text) as n_pieces, md5(text) as text_md5 from documents"


def special_token_hits(spark, sf_dir):
    """How often each reserved token occurs in rendered prompts."""
    prompts = chat.render_turns(t.conversations(spark, sf_dir))
    names = bpe.reserved_tokens()
    pattern = "(" + "|".join(t_.replace("|", r"\|") for t_ in names) + ")"
    hits = prompts.select(F.explode(F.regexp_extract_all("piece", F.lit(pattern), F.lit(1))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    table = literal_table(spark, [(i, x, x in K.SPECIAL_TOKENS) for i, x in enumerate(names)], "id token special")
    return hits.join(F.broadcast(table), "token").select("id", "token", "special", "n")


SPECIAL_TOKEN_HITS = """with n as (select count(*) as t, count(*) filter (where role = 'assistant') as a from conversations)
select 1 as id, '<|im_start|>' as token, true as special, t as n from n union all select 2, '<|im_end|>', true, t from n
union all select 25, '<think>', false, a from n union all select 26, '</think>', false, a from n"""

# Byte ids follow the order of the alphabet: printable bytes first, then the others.
BYTE_IDS_SQL = "[" + ", ".join(str(K.RESERVED_COUNT + bpe.byte_tokens().index(bpe.BYTE_CHAR[b])) for b in range(256)) + "]"


def pretrain_arrays(spark, sf_dir):
    """BOS, ids cut to 512, EOS, padding; labels ignore padding."""
    ids = bpe.encoder(limit=510)(F.col("text"))
    rows = spread(t.documents(spark, sf_dir)).select("doc_id", tokens.pretrain_ids(ids, 512).alias("ids"))
    rows = rows.withColumn("labels", tokens.pretrain_labels(F.col("ids")))
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("width"), arrays.total_int(F.col("ids").cast("array<bigint>")).alias("id_sum"),
        F.size(F.filter("labels", lambda x: x == K.IGNORE_LABEL)).cast("bigint").alias("n_ignored"), F.element_at("ids", 1).cast("bigint").alias("first_id"),
    )


PRETRAIN_ARRAYS = f"""with h as (select doc_id, hex(encode(text)) as h, least(octet_length(encode(text)), 510) as n from documents),
ids as (select doc_id, n, list_transform(range(1, n + 1), lambda i: ({BYTE_IDS_SQL})[cast('0x' || substr(h, 2 * i - 1, 2) as integer) + 1]) as l from h)
select doc_id, cast(512 as bigint) as width, cast(3 + coalesce(list_sum(l), 0) as bigint) as id_sum, 512 - n - 2 as n_ignored, cast(1 as bigint) as first_id from ids"""

SFT_LENGTH = 768


def _label_fn(max_length: int):
    return tokens.answer_labels(*tokens.answer_marks(), max_length)


def sft_labels(spark, sf_dir):
    """Loss only on assistant answers and their end marks, cut to 768 tokens."""
    # A rendered turn has at least one token, so what the cut keeps lies in the first turns.
    turns = t.conversations(spark, sf_dir).where(F.col("turn") < SFT_LENGTH)
    prompts = chat.render_parts(chat.assemble_parts(turns, SFT_LENGTH))
    rows = prompts.select("conv_id", tokens.fixed_length(bpe.encoder(limit=SFT_LENGTH)(F.col("prompt")), SFT_LENGTH).alias("ids"))
    rows = rows.withColumn("labels", _label_fn(SFT_LENGTH)(F.col("ids")))
    mask = tokens.loss_mask(F.col("labels"))
    return rows.select(
        "conv_id", F.size("ids").cast("bigint").alias("width"), F.size(F.filter("ids", lambda x: x == K.PAD_ID)).cast("bigint").alias("n_pad"),
        tokens.label_coverage(mask).alias("n_loss"),
    )


# Token lengths from the text alone: one per byte, one per reserved token.
_TOKENS_SQL = """(octet_length(encode(replace(replace(replace(replace({x}, '<|im_start|>', ''), '<|im_end|>', ''), '<think>', ''), '</think>', '')))
  + case when role = 'assistant' then 4 else 2 end)"""
SFT_LABELS = f"""with p as (select conv_id, turn, role, {TURN_SQL} as piece from conversations),
n as (select *, {_TOKENS_SQL.format(x='piece')} as k from p),
o as (select *, sum(k) over (partition by conv_id order by turn) - k as start from n),
s as (select *, case when role = 'assistant' then greatest(least(start + k, {SFT_LENGTH}) - least(start + 11, {SFT_LENGTH}), 0) else 0 end as loss from o)
select conv_id, cast({SFT_LENGTH} as bigint) as width, cast(greatest({SFT_LENGTH} - sum(k), 0) as bigint) as n_pad, cast(sum(loss) as bigint) as n_loss from s group by conv_id"""


def dpo_arrays(spark, sf_dir):
    """Each side of a preference pair as x, y and mask, one shorter than 1024."""
    length = 1024
    pairs = t.preference_rows(spark, sf_dir).where(F.col("rejected").isNotNull())
    prompt = chat.drop_empty_think(chat.render(F.col("item")), F.concat_ws("-", "pair_id", "side"))
    sides = diagnostics.stack_sides(pairs).select("pair_id", "side", tokens.fixed_length(bpe.encoder(limit=length)(prompt), length).alias("ids"))
    rows = sides.withColumn("loss", tokens.loss_mask(_label_fn(length)(F.col("ids"))))
    rows = rows.select("pair_id", "side", *[c.alias(n) for n, c in tokens.shifted(F.col("ids"), F.col("loss")).items()])
    return rows.select(
        "pair_id", "side", *[F.size(n).cast("bigint").alias(f"len_{n}") for n in ("x", "y", "mask")],
        tokens.label_coverage(F.col("mask")).alias("n_loss"), F.element_at("x", 1).cast("bigint").alias("first_x"), F.element_at("y", 1).cast("bigint").alias("first_y"),
    )


def _side_sql(side: str, x: str) -> str:
    # user turn: mark, 'user', newline, text, mark, newline; then mark + 'assistant' + newline
    start = "(octet_length(encode(source)) + 8 + 11)"
    # The empty think block is 6 tokens, unless it is dropped.
    key = f"pair_id || '-{side}'"
    body = f"(octet_length(encode(ltrim({x}, chr(10)))) + case when {draw('42think', key)} > 0.2 then 0 else 6 end + 2)"
    return f"""select pair_id, '{side}' as side, cast(1023 as bigint) as len_x, cast(1023 as bigint) as len_y, cast(1023 as bigint) as len_mask,
  cast(greatest(least({start} + {body}, 1024) - least({start}, 1024), 0) as bigint) as n_loss, cast(1 as bigint) as first_x,
  cast({K.RESERVED_COUNT + bpe.byte_tokens().index('u')} as bigint) as first_y from pairs where bad is not null"""


DPO_ARRAYS = f"with {t.PAIRS_SQL} {_side_sql('chosen', 'good')} union all {_side_sql('rejected', 'bad')}"


def left_pad(spark, sf_dir):
    """Prompts cut on the left to 256 tokens, padded on the left to 300."""
    rows = spread(t.documents(spark, sf_dir)).select("doc_id", F.transform(F.split("text", " "), lambda w: F.length(w) + 3).alias("ids"))
    out = rows.select("doc_id", tokens.left_padded(F.col("ids"), 256, 300).alias("p"))
    return out.select("doc_id", F.array_join("p", ",").alias("padded"), F.array_join(tokens.mark_pads(F.col("p"), F.transform("p", lambda x: (x != 0).cast("int"))), ",").alias("stripped"))


LEFT_PAD = """with w as (select doc_id, list_transform(string_split(text, ' '), lambda x: length(x) + 3) as l from documents),
k as (select doc_id, l[greatest(len(l) - 256, 0) + 1 : len(l)] as l from w)
select doc_id, array_to_string(list_concat(list_transform(range(0, 300 - len(l)), lambda i: 0), l), ',') as padded, array_to_string(l, ',') as stripped from k"""


def ragged_pad(spark, sf_dir):
    """Batches of 8 rows padded to their longest row, with attention masks."""
    rows = t.conversations(spark, sf_dir).select("conv_id", "turn", F.transform(F.split("text", " "), lambda w: F.length(w) + 3).alias("ids"))
    rows = rows.withColumn("row_id", F.col("conv_id") * 100 + F.col("turn"))
    placed = manifest.batches(manifest.shuffled_positions(rows, "row_id", 42, 0), 8)
    wide = tokens.batch_width(placed, "ids", "batch_id")
    padded = wide.select("conv_id", "turn", "batch_id", "width", tokens.rectangular(F.col("ids"), F.col("width")).alias("p"), tokens.attention(F.col("ids"), F.col("width")).alias("a"))
    return padded.select("conv_id", "turn", "batch_id", F.col("width").cast("bigint").alias("width"), F.array_join("p", ",").alias("padded"),
                         tokens.label_coverage(F.col("a")).alias("n_real"))


RAGGED_PAD = """with w as (select conv_id, turn, list_transform(string_split(text, ' '), lambda x: length(x) + 3) as l,
  row_number() over (order by md5(concat_ws('|', '42', '0', cast(conv_id * 100 + turn as varchar)))) - 1 as pos from conversations),
b as (select *, pos // 8 as batch_id from w), m as (select *, max(len(l)) over (partition by batch_id) as width from b)
select conv_id, turn, batch_id, width, array_to_string(list_concat(l, list_transform(range(0, width - len(l)), lambda i: 0)), ',') as padded, len(l) as n_real from m"""


def dense_batches(spark, sf_dir):
    """Batches of 8 rows as tensors of bytes with a bit for each real token."""
    rows = t.conversations(spark, sf_dir).select("conv_id", "turn", F.transform(F.split("text", " "), lambda w: F.length(w) + 3).alias("ids"))
    rows = rows.withColumn("row_id", F.col("conv_id") * 100 + F.col("turn"))
    placed = manifest.batches(manifest.shuffled_positions(rows, "row_id", 42, 0), 8)
    out = tokens.dense_batches(placed, "ids", "batch_id", "pos")
    sizes = [F.col(c).cast("bigint").alias(c) for c in ("n_rows", "width")]
    return out.select("batch_id", *sizes, F.md5("ids").alias("ids_md5"), F.md5("mask").alias("mask_md5"))


DENSE_BATCHES = """with w as (select list_transform(string_split(text, ' '), lambda x: length(x) + 3) as l,
  row_number() over (order by md5(concat_ws('|', '42', '0', cast(conv_id * 100 + turn as varchar)))) - 1 as pos from conversations),
b as (select *, pos // 8 as batch_id from w), m as (select *, max(len(l)) over (partition by batch_id) as width from b),
h as (select batch_id, pos, width,
  array_to_string(list_transform(l, lambda x: printf('%02X%02X%02X00', x % 256, x // 256 % 256, x // 65536)), '') || repeat('0', 8 * (width - len(l))) as i,
  rpad(repeat('FF', len(l) // 8) || case when len(l) % 8 > 0 then printf('%02X', (1 << (len(l) % 8)) - 1) else '' end, cast(2 * ((width + 7) // 8) as integer), '0') as k from m)
select batch_id, count(*) as n_rows, cast(max(width) as bigint) as width, md5(unhex(string_agg(i, '' order by pos))) as ids_md5, md5(unhex(string_agg(k, '' order by pos))) as mask_md5
from h group by batch_id"""

QUERIES = {
    "corpus_lines": (corpus_lines, CORPUS_LINES),
    "pretoken_counts": (pretoken_counts, PRETOKEN_COUNTS),
    "pair_counts": (pair_counts, PAIR_COUNTS),
    "word_compression": (word_compression, WORD_COMPRESSION),
    "bpe_vocab": (bpe_vocab, None),
    "bpe_compression": (bpe_compression, None),
    "bpe_pretrain_arrays": (bpe_pretrain_arrays, None),
    "bpe_round_trip": (bpe_round_trip, BPE_ROUND_TRIP),
    "byte_round_trip": (byte_round_trip, BYTE_ROUND_TRIP),
    "stream_pieces": (stream_pieces, STREAM_PIECES),
    "special_token_hits": (special_token_hits, SPECIAL_TOKEN_HITS),
    "pretrain_arrays": (pretrain_arrays, PRETRAIN_ARRAYS),
    "sft_labels": (sft_labels, SFT_LABELS),
    "dpo_arrays": (dpo_arrays, DPO_ARRAYS),
    "left_pad": (left_pad, LEFT_PAD),
    "dense_batches": (dense_batches, DENSE_BATCHES),
    "ragged_pad": (ragged_pad, RAGGED_PAD),
}
