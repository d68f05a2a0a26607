"""Queries that apply each operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    contamination,
    langid,
    licenses,
    lines,
    merkle,
    mixture,
    phrases,
    pii,
    quality,
    secrets,
    simhash,
    urls,
    warc,
)
from tillstream.llm.url_examples import LABELLED

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that other documents share."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256")
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in windows of benchmark items."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        items.alias("items_sha256"),
        "contaminated",
    )


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words a mixture by source weight takes of each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixture.mix_sources(docs).select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target", "copies", "taken"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and the near-duplicates it belongs with."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(F.col("_id").alias("doc_id"), "fingerprint", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages archived and read back."""
    return warc.archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])

    def listed(spans: Column) -> Column:
        rows = F.transform(
            spans,
            lambda s: F.struct(
                s.start.alias("start"),
                F.array_position(kinds, s.kind).alias("kind"),
                F.concat_ws(":", s.kind, s.start, s.end).alias("text"),
            ),
        )
        return F.array_join(F.transform(F.array_sort(rows), lambda r: r.text), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint")

    return pii.find_pii(docs).select(
        F.col("_id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify_languages(docs)
    return found.select(F.col("_id").alias("doc_id"), "held_out", "lang_pred", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality features of every document and whether it stays."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = quality.judge_quality(docs, _table(spark, sf_dir, "labels"))
    return found.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.concat_ws(",", "failed_rules").alias("failed_rules"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for the URL of every page."""
    found = urls.judge_urls(_table(spark, sf_dir, "pages"), urls.table_of(spark, LABELLED))
    return found.withColumnRenamed("_id", "page_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select(
        F.col("_id").alias("doc_id"), "license", "containment", "first_word"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, and what lost line ends do to its proof."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in docs.columns]
    tampered = merkle.digest_of(*fields[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    claimed = F.when(chosen, tampered).otherwise(merkle.digest_of(*fields))
    proven = merkle.prove(merkle.build_manifest(docs, claimed=claimed))
    return proven.withColumnRenamed("_id", "doc_id")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading phrases of every language."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return phrases.collocations(docs)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        F.col("_id").alias("doc_id"),
        *[count(rule.name).alias(f"n_{rule.name}") for rule in secrets.BASE_RULES],
        F.sha2(listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_mix_sources": op3_mix_sources,
    "op4_simhash": op4_simhash,
    "op5_warc": op5_warc,
    "op6_pii": op6_pii,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_url_filter": op9_url_filter,
    "op10_license_scan": op10_license_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_collocations": op12_collocations,
    "op13_secret_scan": op13_secret_scan,
}


def _license_sql() -> str:
    """Containment of every notice in every window of its scale, without bands or stretches."""
    rows = []
    for name, text in licenses.NOTICES.items():
        words = ", ".join(f"'{w}'" for w in licenses.notice_words(text))
        rows.append(f"('{name}', [{words}])")
    return r"""
        with given(license, w) as (values %s),
        n as (
            select license, w, size / 4 as stride, size + size / 4 as span
            from (select *, greatest(8, power(2, ceil(log2(len(w))))) as size from given)
        ), ns as (
            select distinct license, stride, span, array_to_string(w[i:i + 4], ' ') as s
            from (select *, unnest(range(1, len(w) - 3)) as i from n)
        ), nt as (select license, stride, span, count(*) as size from ns group by all),
        d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ), ds as (
            select doc_id, i - 1 as p, array_to_string(w[i:i + 4], ' ') as s
            from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d)
        ), hits as (
            select doc_id, license, stride, span, p, s from ds join ns using (s)
        ), held as (
            select doc_id, license, stride * k as start, s, p
            from (select *, unnest(range(
                cast(greatest(0, ceil((p - (span - 5)) / stride)) as bigint),
                cast(floor(p / stride) as bigint) + 1)) as k from hits)
        ), counted as (
            select doc_id, license, start, list(distinct s) as have, min(p) as lo, max(p) + 4 as hi
            from held group by all
        ), matches as (
            select doc_id, license, start, have, len(have) as found,
                len(have) / size as containment, lo, hi
            from counted join nt using (license) where len(have) / size >= 0.8
        )
        select doc_id, license, max(containment) as containment,
            cast(min(start) as bigint) as first_word
        from matches m where not exists (
            select 1 from matches o
            where o.doc_id = m.doc_id and o.license <> m.license and o.lo <= m.hi and m.lo <= o.hi
                and list_has_all(o.have, m.have) and (o.found > m.found or o.found = m.found and (o.containment > m.containment
                    or o.containment = m.containment and o.license < m.license)))
        group by doc_id, license""" % ", ".join(rows)


def _secret_sql() -> str:
    """Every rule on every text, without an index; RE2 folds more than A-Z, so cases are spelled out."""
    spelled = {
        "assign": "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    }
    rows = ", ".join(
        f"({kind}, '{rule.name}', {rule.least}, {rule.base})"
        for kind, rule in enumerate(secrets.RULES)
    )
    matched = " union all ".join(
        "select doc_id, {0} as kind, regexp_extract_all(text, '{1}') as found,"
        " regexp_extract_all(text, '{1}', {2}) as parts,"
        " regexp_split_to_array(text, '{1}') as gaps"
        " from documents where regexp_matches(text, '{1}')".format(
            kind, spelled.get(rule.name, rule.pattern).replace("'", "''"), rule.group
        )
        for kind, rule in enumerate(secrets.RULES)
    )
    return f"""
        with rules(kind, name, least, base) as (values {rows}),
        matched as ({matched}),
        places as (
            select doc_id, kind, i, length(gaps[i]) as gap, length(found[i]) as size,
                length(parts[i]) as part
            from (select *, unnest(range(1, len(found) + 1)) as i from matched)
        ), spans as (
            select *, sum(gap + size) over (partition by doc_id, kind order by i) as stop from places
        ), kept as (
            select doc_id, r.kind, name, base, stop - size as start,
                concat(name, ':', cast(stop - size as bigint), ':', cast(stop as bigint)) as span
            from spans s join rules r on s.kind = r.kind where part >= least
        ), found as (
            select doc_id, count(*) filter (name = 'assign') as n_assign,
                count(*) filter (name = 'access') as n_access, count(*) filter (name = 'hex') as n_hex,
                string_agg(span, ',' order by start, kind) filter (base) as base_spans,
                string_agg(span, ',' order by start, kind) as all_spans
            from kept group by doc_id
        )
        select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
            coalesce(n_hex, 0) as n_hex, sha256(coalesce(base_spans, '')) as base_sha256,
            coalesce(all_spans, '') as spans
        from documents d left join found f on d.doc_id = f.doc_id"""


SQL: dict[str, str] = {
    "op11_merkle_manifest": r"""
        with recursive hashed as (
            select doc_id, source, sha256(concat(
                    coalesce(concat(octet_length(encode(cast(doc_id as varchar))), ':', doc_id), '-'),
                    coalesce(concat(octet_length(encode(source)), ':', source), '-'),
                    coalesce(concat(octet_length(encode(lang)), ':', lang), '-'),
                    coalesce(concat(octet_length(encode(cast(n_chars as varchar))), ':', n_chars), '-'),
                    coalesce(concat(octet_length(encode(t)), ':', t), '-'))) as h, side
            from (select *, text as t, 0 as side from documents
                union all
                select *, replace(text, chr(10), '') as t, 1 as side from documents)
        ), crc as (
            select doc_id, list_reduce(
                list_prepend(4294967295, flatten(list_transform(
                    string_split(cast(doc_id as varchar), ''),
                    lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, x: case when x >= 0 then xor(a, x)
                    when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c
            from documents
        ), leaves as (
            select o.doc_id, o.source, o.h as leaf,
                case when xor(c, 4294967295) % 2 = 0 then t.h else o.h end as claimed,
                row_number() over (partition by o.source order by o.doc_id) - 1 as pos,
                count(*) over (partition by o.source) as n
            from hashed o join hashed t on o.side = 0 and t.side = 1 and o.doc_id = t.doc_id
            join crc on crc.doc_id = o.doc_id
        ), ranks as (
            select source, row_number() over (order by source nulls first) - 1 as rank
            from (select distinct source from documents)
        ), lv as (
            select rank as tree, 0 as level, pos, leaf as h, n
            from leaves l join ranks r on l.source is not distinct from r.source
            union all
            select tree, level + 1, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3
            from lv where n > 1 group by tree, level, pos // 3, n
        ), top as (
            select 0 as level, tree as pos, h, (select count(*) from ranks) as n from lv where n = 1
            union all
            select level + 1, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3
            from top where n > 1 group by level, pos // 3, n
        ), runs as (
            select tree, level, pos // 3 as run, list(h order by pos) as hs
            from lv where n > 1 group by all
            union all
            select -1, level, pos // 3, list(h order by pos) from top where n > 1 group by all
        ), climb as (
            select doc_id, rank, rank as tree, 0 as level, pos, claimed as folded, '' as proof
            from leaves l join ranks r on l.source is not distinct from r.source
            union all
            select doc_id, rank, c.tree, c.level + 1, pos // 3,
                sha256(array_to_string(list_concat(list_append(hs[:pos % 3], folded), hs[pos % 3 + 2:]), '')),
                proof || array_to_string(list_concat(hs[:pos % 3], hs[pos % 3 + 2:]), '')
            from climb c join runs r on r.tree = c.tree and r.level = c.level and r.run = c.pos // 3
        ), subs as (
            select c.* from climb c join lv on lv.tree = c.rank and lv.n = 1 and lv.level = c.level
        ), over_top as (
            select doc_id, 0 as level, rank as pos, folded, proof from subs
            union all
            select doc_id, c.level + 1, pos // 3,
                sha256(array_to_string(list_concat(list_append(hs[:pos % 3], folded), hs[pos % 3 + 2:]), '')),
                proof || array_to_string(list_concat(hs[:pos % 3], hs[pos % 3 + 2:]), '')
            from over_top c join runs r on r.tree = -1 and r.level = c.level and r.run = c.pos // 3
        )
        select l.doc_id, leaf, s.h as subroot, top.h as root, sha256(proof) as proof_sha256,
            folded as folded_root, folded = top.h as verified
        from leaves l join ranks r on l.source is not distinct from r.source
        join lv s on s.tree = r.rank and s.n = 1
        join top on top.n = 1
        join over_top o on o.doc_id = l.doc_id and o.level = top.level""",
    "op13_secret_scan": _secret_sql(),
    "op12_collocations": r"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
            from documents
        ), words as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
        ), sizes as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
        grams as (
            select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
            from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
                from words, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k)
        ), f as (
            select lang, k, phrase, count(*) as a from grams group by all having count(*) >= 30
        ), cuts as (
            select lang, k, phrase, a, string_split(phrase, ' ') as w, unnest(range(1, k)) as cut
            from f where k > 1
        ), parts as (
            select c.lang, c.phrase, c.a, cut, x.a as l, y.a as r,
                cast(cast(2000000 as hugeint) * c.a // (x.a + y.a) as bigint) as score
            from cuts c
            join f x on x.lang = c.lang and x.phrase = array_to_string(w[:cut], ' ')
            join f y on y.lang = c.lang and y.phrase = array_to_string(w[cut + 1:], ' ')
        ), scored as (
            select lang, phrase, a, l, r, score from parts
            qualify row_number() over (partition by lang, phrase order by score, cut) = 1
        ), inner_parts as (
            select lang, a, k, w, size, unnest(range(1, k - size + 2)) as i
            from (select *, string_split(phrase, ' ') as w, unnest(range(2, k)) as size from f)
        ), covers as (
            select lang, array_to_string(w[i:i + size - 1], ' ') as phrase, max(a) as longer
            from inner_parts group by all
        ), kept as (
            select s.* from scored s left join covers c on s.lang = c.lang and s.phrase = c.phrase
            where longer is null or 100 * longer < 80 * a
        ), ranked as (
            select *, row_number() over (
                partition by lang order by score desc, a desc, phrase) as rank from kept
        )
        select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang)
        where rank <= 2000""",
    "op10_license_scan": _license_sql(),
    "op2_decontaminate": r"""
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ), b as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from benchmark
        ), items as (
            select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win
            from (select item_id, w, least(13, len(w)) as n,
                unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from b where len(w) > 0)
        ), wins as (
            select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
                from d, (select distinct n from items) where len(w) >= n)
        ), hits as (
            select doc_id, i, w.n, item_id from wins w join items using (win)
        ), words as (
            select doc_id, count(distinct p) as n_hit
            from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id
        ), found as (
            select doc_id, count(distinct item_id) as n_items,
                array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids
            from hits group by doc_id
        )
        select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
            coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
            coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
        from d left join words on d.doc_id = words.doc_id left join found on d.doc_id = found.doc_id""",
    "op1_line_dedup": r"""
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
            from documents
        ), keyed as (
            select doc_id, place, line,
                translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from lines
        ), shared as (
            select key, max(doc_id) as keeper from keyed where length(key) >= 20
            group by key having count(distinct doc_id) >= 3
        ), marked as (
            select k.doc_id, k.place, k.line, s.key is not null and k.doc_id <> s.keeper as dropped
            from keyed k left join shared s on k.key = s.key
        )
        select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), ''))
                as kept_sha256
        from marked group by doc_id""",
    "op5_warc": r"""
        with p as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                sha256(coalesce(html, '')) as payload_digest
            from pages
        ), f as (
            select payload_digest, min(page_id) as first from p
            where payload_bytes >= 100 group by payload_digest
        )
        select page_id, payload_bytes, p.payload_digest,
            case when page_id <> first then 'revisit' else 'response' end as record_type,
            case when page_id <> first then first end as refers_to
        from p left join f on p.payload_digest = f.payload_digest""",
}
