"""The queries of this subpackage, with the SQL that some of them can be checked by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bit_sliced_simhash, chunk_recipes, compression_bands, cover_forest, deobfuscated_toxicity, feistel_pseudonyms, importance_resampling, katz_backoff, line_bitmaps, phrase_automata, run_length_index, source_schedule, template_windows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = template_windows.leaked_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "n_windows", "n_matched", "n_reworded")


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = feistel_pseudonyms.with_pseudonyms(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_found", "found.*")


def op3_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_backoff.katz_scores(_table(spark, sf_dir, "documents"), order=3)


def op4_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_schedule.mixed_documents(_table(spark, sf_dir, "documents")).drop("first_slot")


def op5_bit_sliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bit_sliced_simhash.simhash_components(_table(spark, sf_dir, "documents"))
    # stored in little-endian bytes
    return found.select("doc_id", F.lower(F.hex(F.concat(*[F.substring("bits", i, 1) for i in range(8, 0, -1)]))).alias("fingerprint"), "component_id", "component_rows")


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_bitmaps.without_common_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_length_index.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deobfuscated_toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_recipes.exact_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.collocations(_table(spark, sf_dir, "documents"))


def op12_cover_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = cover_forest.integer_vectors(_table(spark, sf_dir, "embeddings").withColumn("label", label))
    return cover_forest.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.measured_documents(_table(spark, sf_dir, "documents")).drop("row")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_template_windows": op1_template_windows,
    "op2_feistel_pseudonyms": op2_feistel_pseudonyms,
    "op3_katz_backoff": op3_katz_backoff,
    "op4_source_schedule": op4_source_schedule,
    "op5_bit_sliced_simhash": op5_bit_sliced_simhash,
    "op6_importance_resampling": op6_importance_resampling,
    "op7_line_bitmaps": op7_line_bitmaps,
    "op8_run_length_index": op8_run_length_index,
    "op9_deobfuscated_toxicity": op9_deobfuscated_toxicity,
    "op10_chunk_recipes": op10_chunk_recipes,
    "op11_phrase_automata": op11_phrase_automata,
    "op12_cover_forest": op12_cover_forest,
    "op13_compression_bands": op13_compression_bands,
}

# The words a document gives follow from its place in the stream of its source: no schedule is needed to count them.
MIXED_SQL = r"""
        with sized as (
            select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from {documents}),
        sources as (
            select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
            from sized group by source),
        filling as (
            select *, row_number() over by_cap as place, weight as w,
                   (sum(source_size) over () - coalesce(sum(3 * source_size) over (by_cap rows between unbounded preceding and 1 preceding), 0))::double
                       / (sum(weight) over (by_cap rows between current row and unbounded following))::double as level
            from sources window by_cap as (order by 3 * source_size / weight::double, source nulls last)),
        targets as (
            select source, source_size,
                   least(3 * source_size::double, weight * (select arg_min(level, place) from filling where level * w <= 3 * source_size)) as target
            from filling),
        streamed as (
            select *, coalesce(sum(size) over (partition by source order by md5(coalesce(doc_id::varchar, '')), doc_id, size
                rows between unbounded preceding and 1 preceding), 0) as start
            from sized)
        select doc_id, size, source_size, target,
               (greatest(0, least(start + size, floor(target)) - start)
                + greatest(0, least(start + size, floor(target) - source_size) - start)
                + greatest(0, least(start + size, floor(target) - 2 * source_size) - start))::bigint as taken
        from streamed join targets on streamed.source is not distinct from targets.source"""

SQL: dict[str, str] = {
    "op4_source_schedule": MIXED_SQL.replace("{documents}", "documents"),
    "op7_line_bitmaps": """
        with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
        numbered as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from parts),
        keyed as (
            select *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key
            from numbered),
        common as (select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10),
        judged as (select *, key in (select key from common) as gone from keyed)
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
        from judged group by doc_id""",
    "op10_chunk_recipes": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))""",
    "op11_phrase_automata": r"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
            from documents),
        worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
        totals as (select lang, sum(len(w))::hugeint as n from worded group by lang),
        grams as (
            select lang, k, w[i : i + k - 1] as words
            from worded, unnest(range(1, 6)) as sizes(k), lateral unnest(range(1, len(w) - k + 2)) as starts(i)),
        counted as (select lang, words, count(*) as f from grams group by all having count(*) >= 100),
        candidates as (select lang, words, f as a from counted where len(words) > 1),
        covered as (
            select c.lang, c.words from candidates c join candidates d
            on c.lang = d.lang and len(d.words) = len(c.words) + 1 and c.a = d.a and (d.words[1 : len(c.words)] = c.words or d.words[2:] = c.words)),
        cuts as (select lang, words, a, unnest(range(1, len(words))) as k from candidates),
        scored as (
            select c.lang, c.words, c.a, l.f as l, r.f as r, n, k, (1000 * a::hugeint * n) // (l.f::hugeint * r.f) as score
            from cuts c join totals t on c.lang = t.lang
            join counted l on l.lang = c.lang and l.words = c.words[1:k] join counted r on r.lang = c.lang and r.words = c.words[k + 1 :]),
        best as (select * from scored qualify row_number() over (partition by lang, words order by score, k) = 1)
        select lang, row_number() over top as rank, array_to_string(words, ' ') as phrase, a, l, r, n::bigint as n, score::bigint as score
        from best b where not exists (select 1 from covered v where v.lang = b.lang and v.words = b.words)
        window top as (partition by lang order by score desc, a desc, array_to_string(words, ' '))
        qualify rank <= 2000""",
    "op12_cover_forest": """
        with vectors as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
        scored as (
            select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
            from vectors a join vectors b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
        positives as (
            select anchor_id, id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
        select p.anchor_id, positive_id, (row_number() over best)::int as rank, s.id as negative_id, positive_score, s.score as negative_score
        from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
        where 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score
        window best as (partition by p.anchor_id, positive_id order by s.score desc, s.id)
        qualify rank <= 5""",
}
