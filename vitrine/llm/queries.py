"""One query for each operator, over its whole table. See the contracts in the README."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (chat, decontaminate, digest, mixing, quality, repair, simhash, token_counts, token_files, toxicity,
               url_filter, warc, whitening)

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest) of each benchmark item that a document leaks."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every derived record of the pages' responses."""
    return warc.derivatives(warc.responses(_table(spark, sf_dir, "pages")))


def op5_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.digest_neighbours(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted through a cache that is new in each run, so every distinct text is encoded."""
    import public_tokenizers

    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                     scratch_path(spark, "token-cache"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.add_scores(docs.select("doc_id", "text"), net, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture at shares in proportion to the square root of a source's documents, in its order."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "text", "lang", "source", "n_chars", "copy", F.round("rate", 6).alias("rate"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, log_weight, gumbel_key) of each sampled document."""
    return quality.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


STYLES = {"system": ("System: ", "[system] ", "**System:** ", "### Context: "),
          "user": ("User: ", "[human] ", "**Q:** ", "### Instruction: "),
          "assistant": ("Assistant: ", "[ai] ", "**A:** ", "### Response: "),
          "tool": ("Tool: ", "[function] ", "**Observation:** ", "### Tool result: ")}


def transcripts(conversations: DataFrame, role_too: bool = False) -> DataFrame:
    """Messages as a transcript has them: without roles (but for fitting), most with a speaker marker in
    the style of their conversation, three in ten without one (by a hash of conversation and turn)."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4)).cast("int")
    marker = F.lit("")
    for role, forms in STYLES.items():
        marker = F.when(F.lower("role") == role, F.array(*map(F.lit, forms))[style]).otherwise(marker)
    bare = F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(10)) < 3
    return conversations.select("conv_id", "turn", *(["role"] if role_too else []), F.concat(F.when(bare, "").otherwise(marker),
                                                            F.coalesce("text", F.lit(""))).alias("text"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical turns of the conversations' transcripts, which are parsed by their lines: neither roles nor where
    a message begins is passed on. The model is fitted to the messages of the conversations outside the
    held-out fifth, as their transcripts show them."""
    conversations = _table(spark, sf_dir, "conversations")
    known = transcripts(conversations.filter(~held_out(F.col("conv_id"))), role_too=True)
    return chat.canonical_turns(transcripts(conversations), chat.fit(known))


WORD_TOKENIZER, END_ID = "word_bpe_49k.json", 2


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), all from the files written in this run."""
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    token_files.write_ids(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return token_files.read_checksums(spark, path)


def damaged(conversations: DataFrame) -> DataFrame:
    """Messages with a twentieth each dropped, emptied, stripped of its full stops, repeated, made the user's."""
    own = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    rows = conversations.select("conv_id", "turn", own["role"].alias("role"), own["text"].alias("text"),
                                (F.crc32(F.concat(own["conv_id"], F.lit(":"), own["turn"]).cast("binary")) % 20).alias("how"))
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.filter("how <> 0").select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
                                           text.alias("text"), F.explode(copies).alias("copy")).drop("copy"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair.repair(damaged(conversations), conversations)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_simhash, op3_url_filter, op4_warc, op5_digest, op6_token_counts,
                                   op7_toxicity, op8_mixing, op9_quality, op10_chat, op11_token_files, op12_repair, op13_whitening)}


def _any_of(terms: tuple[str, ...]) -> str:
    return " + ".join(f"cast(regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])') as int)" for t in terms)


def _url_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rules = sorted(url_filter.RULES, key=lambda r: -len(r.name))
    fits = " ".join(f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.name}'"
                    for r in rules)
    verdicts = " ".join(f"when rule = '{r.name}' then '{r.verdict}'" for r in rules)
    return f"""
        with parts as (
            select page_id, translate(coalesce(url, ''), '{upper}', '{lower}') as low,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}') as host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
            from pages),
        ruled as (
            select page_id, host, path, case {fits} end as rule,
                   cast({_any_of(url_filter.STRICT)} as int) as strict_hits, cast({_any_of(url_filter.SOFT)} as int) as soft_hits
            from parts)
        select page_id, host, path, rule, strict_hits, soft_hits,
               case {verdicts} when strict_hits >= 1 or soft_hits >= {url_filter.SOFT_HITS} then 'block' else 'allow' end as verdict
        from ruled"""


def mixing_sql(columns: tuple[str, ...], source: str = "documents", power: float = 0.5) -> str:
    """The mixture of a table with these columns, in any order, with copy and rate. A rate above the largest part's
    is the sum of Poisson parts."""
    def uniform(purpose: str) -> str:
        return f"cast(concat('0x', substr(md5(concat('{mixing.SEED}:', {purpose}, ':', row_key)), 1, 13)) as bigint) * power(2.0, -52)"

    most = mixing.MAX_RATE
    values = ", ".join(f"coalesce(cast({c} as varchar), 'null')" for c in columns)
    return f"""
        with recursive counts as (
            select source, count(*) as n, power(cast(count(*) as double), {power}) as share from {source} group by source),
        rates as (
            select source, cast(sum(n) over () as double) * share / sum(share) over () / n as rate from counts),
        parted as (
            select source, rate, greatest(cast(ceil(rate / {most}) as int) - 1, 0) as parts from rates),
        steps as (
            select source, rate - parts * {most} as rest, 0 as k, exp(-(rate - parts * {most})) as p, exp(-(rate - parts * {most})) as total
            from parted
            union all
            select source, rest, k + 1, p * rest / (k + 1), total + p * rest / (k + 1) from steps
            where k < 160 and not (k + 1 > rest and total + p * rest / (k + 1) = total)),
        part_steps as (
            select 0 as k, exp(cast(-{most} as double)) as p, exp(cast(-{most} as double)) as total
            union all
            select k + 1, p * {most} / (k + 1), total + p * {most} / (k + 1) from part_steps
            where k < 200 and not (k + 1 > {most} and total + p * {most} / (k + 1) = total)),
        keyed as (
            select *, row_number() over () as row_at, md5(concat_ws(chr(31), {values})) as row_key from {source}),
        first_part as (
            select row_at, count(*) as n from (select row_at, source, {uniform("'count'")} as u from keyed) d
            join steps s on d.source is not distinct from s.source and s.total <= d.u group by row_at),
        other_parts as (
            select row_at, count(*) as n
            from (select row_at, {uniform("concat('part:', part)")} as u
                  from (select row_at, row_key, unnest(range(1, parts + 1)) as part
                        from keyed d join parted r on d.source is not distinct from r.source)) d
            join part_steps s on s.total <= d.u group by row_at),
        times as (
            select row_at, cast(sum(n) as bigint) as n from (select * from first_part union all select * from other_parts) group by row_at)
        select {", ".join("d." + c for c in columns)}, unnest(range(t.n)) as copy, r.rate
        from keyed d join times t using (row_at) join parted r on d.source is not distinct from r.source"""


DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SQL = {
    "op3_url_filter": _url_sql(),
    "op8_mixing": f"select doc_id, text, lang, source, n_chars, cast(copy as int) as copy, round(rate, 6) as rate from ({mixing_sql(DOCUMENT_COLUMNS)})",
}
