"""The corpus queries: each applies its operator to its whole table and gives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.llm import (
    exact_dedup,
    fill_middle,
    html_text,
    mixing,
    packing,
    pii,
    quality_rules,
    quality_votes,
    ranked_search,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)
from freshet.llm.frames import read


def op1_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(read(spark, sf_dir, "documents"))
    kept = quality_rules.passes(quality_rules.CORPUS)
    base_failed = ~quality_rules.passes(quality_rules.BASE)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & kept).alias("kept"), "failed",
    )


def op2_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    machine = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select("doc_id", "held_out", "score", "predicted")


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(read(spark, sf_dir, "documents"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = pii.find(read(spark, sf_dir, "documents"))
    return pii.digest(rows, found).drop("_row")


def op6_deep_shallow_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.passages(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_zstd_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.archived(read(spark, sf_dir, "pages")))


def op8_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(read(spark, sf_dir, "documents")))


def op9_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op10_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_swar_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.transform(read(spark, sf_dir, "documents")))


def op12_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_votes.score(docs, quality_votes.train(docs, read(spark, sf_dir, "labels")))


def op13_document_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_rule_ledger,
        op2_toxicity_machine,
        op3_pattern_packing,
        op4_chunk_recipes,
        op5_boosted_spans,
        op6_deep_shallow_suffixes,
        op7_zstd_archives,
        op8_simhash_blocks,
        op9_layout_text,
        op10_sainte_lague,
        op11_swar_fill_middle,
        op12_neighbour_votes,
        op13_document_tree,
    )
}

ORACLES = {
    "op1_rule_ledger": r"""
        with texts as (
            select doc_id, coalesce(text, '') as t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
            from documents
        ), windows as (
            select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as times
            from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from texts)
        ), repeats as (
            select doc_id, count(distinct p) as n_repeat_words
            from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows where times > 1)
            group by doc_id
        ), lines as (
            select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
            from (select doc_id, unnest(string_split(t, chr(10))) as line from texts)
            where regexp_matches(line, '[^\x20\x09-\x0D]')
            group by doc_id
        ), measured as (
            select doc_id, cast(len(ws) as bigint) as n_words,
                   cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
                   cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
                   coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
                   coalesce(n_repeat_words, 0) as n_repeat_words
            from texts left join repeats using (doc_id) left join lines using (doc_id)
        ), failing as (
            select *, cast(n_words < 50 as bigint) + 2 * cast(100 * n_repeat_words > 50 * n_words as bigint)
                   + 4 * cast(10 * n_symbols > n_words as bigint) + 8 * cast(2 * n_dup_lines > n_lines as bigint)
                   + 16 * cast(word_chars < 2 * n_words as bigint) + 32 * cast(word_chars > 20 * n_words as bigint)
                   + 64 * cast(n_words > 1000000 as bigint) as failed
            from measured
        )
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               failed & 3 <> 0 as base_failed, failed & 63 = 0 as kept, failed
        from failing
    """,
    "op7_zstd_archives": r"""
        with payloads as (
            select page_id, coalesce(html, '') as payload, sha1(encode(coalesce(html, ''))) as hex from pages
        ), bits as (
            select *, array_to_string([lpad(bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')
                                       for i in range(1, 41)], '') as bits
            from payloads
        ), digests as (
            select page_id, cast(octet_length(encode(payload)) as bigint) as payload_bytes,
                   array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       1 + cast('0b' || substr(bits, 5 * i + 1, 5) as int), 1) for i in range(0, 32)], '') as payload_digest,
                   min(page_id) over (partition by payload) as first_id
            from bits
        )
        select page_id, payload_bytes, payload_digest,
               case when page_id = first_id then 'response' else 'revisit' end as record_type,
               case when page_id <> first_id then first_id end as refers_to
        from digests
    """,
    "op10_sainte_lague": r"""
        with sized as (
            select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
            from documents
        ), totals as (
            select source, cast(sum(size) as bigint) as words,
                   row_number() over (order by encode(source) nulls last) - 1 as rank
            from sized group by source
        ), weighed as (
            select *, [5, 2, 1][1 + rank % 3] as w, cast(2 * words as double) / [5, 2, 1][1 + rank % 3] as ratio,
                   1.5 * (select sum(size) from sized)::double as total
            from totals
        ), upto as (
            select *, total - coalesce(sum(2 * words) over before, 0) as room,
                   (select sum(w) from weighed) - coalesce(sum(w) over before, 0) as open_weight
            from weighed
            window before as (order by ratio, rank rows between unbounded preceding and 1 preceding)
        ), filled as (
            select *, room::double * w / open_weight >= 2 * words as sated,
                   coalesce(bool_and(room::double * w / open_weight >= 2 * words) over (order by ratio, rank
                            rows between unbounded preceding and 1 preceding), true) as all_before
            from upto
        ), level as (
            select min_by(struct_pack(room, open_weight), struct_pack(ratio, rank)) as l from filled where not (sated and all_before)
        ), wanted as (
            select source, rank, words, total,
                   case when sated and all_before then cast(2 * words as double)
                        else (select l.room from level)::double * w / (select l.open_weight from level) end as target
            from filled
        ), seats as (
            select rank, row_number() over (order by target / (2 * seat + 1) desc, rank, seat) as place,
                   total - (select coalesce(sum(case when target >= 2 * words then 2 * words
                                                     when target < 16 then round_even(target, 0) else 0 end), 0)
                            from wanted) as open_words
            from (select rank, target, total, unnest(range(0, 2 * words // 16)) as seat
                  from wanted where target >= 16 and target < 2 * words)
        ), blocks as (
            select rank, count(*) as blocks from seats where place <= round_even(open_words / 16, 0) group by rank
        ), sources as (
            select wanted.*, coalesce(blocks, 0) as blocks, target >= 2 * words as full_take,
                   case when target < 16 and target < 2 * words then cast(round_even(target, 0) as bigint) else 0 end as part
            from wanted left join blocks using (rank)
        ), placed as (
            select s.doc_id, s.size, t.words as source_size, t.target, t.blocks, t.full_take, t.part, t.rank,
                   ('0x' || substr(md5('11:' || s.doc_id), 1, 8))::bigint % greatest(1, cast(ceil(t.words / greatest(131072, ceil(t.words / 1048576))) as bigint)) as shard,
                   ('0x' || substr(md5('11:' || s.doc_id), 9, 8))::bigint as place
            from sized s join sources t on s.source is not distinct from t.source
        ), cells as (
            select rank, shard, blocks, full_take, part, sum(size)::bigint as cell from placed group by all
        ), cell_seats as (
            select rank, shard, blocks, row_number() over (partition by rank order by cell / (2 * seat + 1) desc, shard, seat) as place
            from (select *, unnest(range(0, cell * 2 // 16)) as seat from cells)
        ), quotas as (
            select rank, shard, count(*) * 16 as words from cell_seats where place <= blocks group by all
        ), largest as (
            select rank, arg_min(shard, struct_pack(a := -cell, b := shard)) as shard from cells group by rank
        ), streamed as (
            select p.*, c.cell,
                   case when p.full_take then 2 * c.cell when p.blocks > 0 then coalesce(q.words, 0)
                        when l.shard is not null then least(p.part, 2 * c.cell) else 0 end as quota,
                   sum(p.size) over (partition by p.rank, p.shard order by p.place, p.doc_id, p.size)::bigint as last,
                   16 * (('0x' || substr(md5('11:' || p.shard), 17, 8))::bigint % greatest(1, c.cell // 16)) as start
            from placed p join cells c using (rank, shard) left join quotas q using (rank, shard)
                 left join largest l on l.rank = p.rank and l.shard = p.shard
        ), cut as (
            select *, last - size as first, case when cell > 0 then quota // cell else 0 end as passes,
                   case when cell > 0 then quota % cell else 0 end as rest
            from streamed
        )
        select doc_id, size, source_size, target,
               cast(passes * size
                    + greatest(0, least(last, start + rest, cell) - greatest(first, start))
                    + greatest(0, least(last, start + rest - cell) - first) as bigint) as taken
        from cut
    """,
    "op4_chunk_recipes": r"""
        with bare as (
            select doc_id, length(coalesce(text, '')) as n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare
            from documents
        ), ranked as (
            select doc_id, bare,
                   row_number() over same_text as place,
                   first_value(doc_id) over same_text as keep_id
            from bare
            window same_text as (partition by bare order by n desc, doc_id nulls last
                                 rows between unbounded preceding and unbounded following)
        )
        select doc_id, keep_id, count(*) over (partition by bare) as group_size,
               place = 1 as kept, sha256(bare) as text_sha256
        from ranked
    """,
    "op11_swar_fill_middle": r"""
        with texts as (
            select doc_id, coalesce(text, '') as t, cast(length(coalesce(text, '')) as bigint) as n,
                   sha256('1:' || coalesce(cast(doc_id as varchar), '')) as hex
            from documents
        ), drawn as (
            select doc_id, t, n, cast('0x' || substr(hex, 1, 8) as bigint) % (n + 1) as one,
                   cast('0x' || substr(hex, 9, 8) as bigint) % (n + 1) as two,
                   case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                             or cast('0x' || substr(hex, 17, 8) as bigint) % 100 >= 90 then 'plain'
                        when cast('0x' || substr(hex, 25, 8) as bigint) % 100 < 20 then 'spm' else 'psm' end as form
            from texts
        ), cut as (
            select *, least(one, two) as a, greatest(one, two) as b from drawn
        ), parts as (
            select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix from cut
        )
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
               case when form <> 'plain' then b - a end as middle_chars,
               sha256(case form when 'plain' then t
                                when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
               sha256(t) as restored_sha256
        from parts
    """,
    "op13_document_tree": r"""
        with words as (
            select doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from (select doc_id, text, row_number() over () as row from documents)
        ), items as (
            select item_id, row, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) as term
            from (select item_id, text, row_number() over () as row from benchmark)
        ), lengths as (
            select row, doc_id, count(*) as n from words group by all
        ), corpus as (
            select count(*) as n_docs, sum(n)::bigint as n_terms from lengths
        ), counted as (
            select row, term, count(*) as tf from words where term in (select term from items) group by all
        ), weights as (
            select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from counted, corpus group by term, n_docs
        ), scored as (
            select i.row as item, i.item_id, c.row, l.doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::bigint as score
            from items i join counted c using (term) join weights using (term) join lengths l on l.row = c.row, corpus
            group by all
        ), ranked as (
            select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from scored where score > 0
        )
        select item_id, rank::int as rank, doc_id, score from ranked where rank <= 50
    """,
}
