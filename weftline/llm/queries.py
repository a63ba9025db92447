"""The queries of the training-data operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _crc_mod(n: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(-1))


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .covertree import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit_quality, score_quality

    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.where(_crc_mod(5) != 0), label="quality")
    scored = score_quality(docs, model)
    return scored.select("doc_id", (_crc_mod(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licences import fit_licences, scan_licences

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(docs, fit_licences(docs))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit_language, predict_language

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language(docs.where(_crc_mod(4) != 2))
    return predict_language(docs.select("doc_id", "text"), model).select("doc_id", (_crc_mod(4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spotsigs import fingerprints_with_edits

    return fingerprints_with_edits(_table(spark, sf_dir, "documents"))


def spotsigs_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of equal fingerprints and the number of classes
    that it links to at 0.8: op9's join, by length partitions and pruned Jaccard."""
    from .spotsigs import spot_links

    links, member = spot_links(_table(spark, sf_dir, "documents"))
    counts = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    return member.join(counts, "class", "left").select("doc_id", "class", F.coalesce("links", F.lit(0)).alias("links"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import dedup_lines

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = dedup_lines(docs)
    return kept.select("doc_id", F.size("removed_lines").cast("long").alias("n_removed"), F.length("text").cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_linefreq(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linefreq import COUNTS, judge_lines

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge_lines(docs).select("doc_id", *COUNTS, "base_failed", "kept", F.size("removed_lines").cast("long").alias("n_removed_lines"), "removed_words")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import clusters_with_inertia

    return clusters_with_inertia(_table(spark, sf_dir, "embeddings"))


def op13_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .upsert import DELETE, SET, digests, latest, new_folder, upsert, write_sorted

    clients, changes = _table(spark, sf_dir, "clients"), _table(spark, sf_dir, "client_changes")
    crc = lambda c: F.crc32(c.cast("string").cast("binary"))
    most, folder = 1 + clients.count() // 1000, new_folder(spark)
    table = write_sorted(clients.where(crc(F.col("client_id")) % 7 > 3), "client_id", most, folder)
    changed = ["source", "segment", "city", "balance"]
    wins = latest(changes.select("client_id", "seq", "change_id", "op", *changed), "client_id", ["seq", "change_id"])

    def action(change, first):
        h = crc(first) % 16
        gone = F.coalesce(change["op"] == "D", F.lit(False)) | F.coalesce(crc(change["change_id"]) % 8 < h, F.lit(False))
        return F.when(h <= 7, F.when(gone, DELETE).otherwise(SET))

    files = upsert(table, wins, changed, most, action)
    cents = lambda c: F.floor(100 * c["balance"] + 0.5)
    crcs = lambda c: F.crc32(F.concat_ws("|", *[F.coalesce(c[n], F.lit("")) for n in ("source", "segment", "city")]).cast("binary"))
    found = digests(table, files, lambda c: {"cents": cents(c), "rows_crc": crcs(c)})
    return found.select("first_id", "n_rows", "cents", "rows_crc", "ids_sha256", "columns", F.concat(F.lit(f"{folder}/"), "name").alias("path"), "rewritten")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(prepare(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_topk, op2_quality, op3_packing, op4_licences, op5_language, op6_suffixes, op7_simhash, op8_mixing, op9_spotsigs, op10_lines, op11_linefreq, op12_centroids, op13_upsert, pipeline, spotsigs_links)
    return {f.__name__: f for f in found}


#: All pairs of a query and another vector, over quantised components.
TOP_K_SQL = """
with v as (select distinct vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
           where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, d.vec_id, cast(list_inner_product(cast(q.e as double[]), cast(d.e as double[])) as bigint) as score
      from v q join v d on q.vec_id % 50 = 0 and q.vec_id <> d.vec_id and len(q.e) = len(d.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""

#: Lines of 20 characters or more that an earlier line equals within one edit.
#: For the self-join, lines within one edit share their first or last half.
LINES_SQL = r"""
with t as (select doc_id, text, string_split(text, chr(10)) as parts from documents),
l as (select doc_id, i - 1 as line, trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as s
      from (select doc_id, parts, unnest(generate_series(1, len(parts))) as i from t)),
k as (select doc_id, line, s, length(s) as n, row_number() over (order by doc_id, line) as pos from l where length(s) >= 20),
u as (select s, n, min(pos) as pos from k group by s, n),
h as (select s, n, pos, unnest([n, n - 1]) as m from u),
p as (select s, n, pos, m, 0 as side, left(s, m // 2) as half from h union all select s, n, pos, m, 1, right(s, m // 2) from h),
near as (select distinct b.pos from p a join p b on a.m = b.m and a.side = b.side and a.half = b.half and a.pos < b.pos
         where abs(a.n - b.n) <= 1 and levenshtein(a.s, b.s) <= 1),
gone as (select k.doc_id, k.line from k join u on k.s = u.s where k.pos <> u.pos or u.pos in (select pos from near)),
g as (select doc_id, list(line) as lines from gone group by doc_id),
r as (select t.doc_id, coalesce(len(g.lines), 0) as n_removed,
             case when g.lines is null then t.text else
               coalesce(array_to_string([t.parts[i] for i in generate_series(1, len(t.parts)) if not list_contains(g.lines, i - 1)], chr(10)), '') end as kept
      from t left join g using (doc_id))
select doc_id, cast(n_removed as bigint) as n_removed, cast(length(kept) as bigint) as kept_chars, sha256(coalesce(kept, '')) as kept_sha256 from r
"""


#: Every window of 100 bytes (as 200 hex digits); those that stand earlier too
#: cover what goes.
REPEATS_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, p, substr(h, cast(2 * p + 1 as bigint), 200) as s from (select doc_id, h, unnest(generate_series(0, cast(length(h) // 2 as bigint) - 100)) as p from d where length(h) >= 200)),
r as (select doc_id, p, row_number() over (partition by s order by doc_id, p) as k from w),
g as (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from r where k > 1),
i as (select doc_id, p, sum(case when before is null or p > before + 100 then 1 else 0 end) over (partition by doc_id order by p) as run from g),
runs as (select doc_id, run, min(p) as a, max(p) + 100 as b from i group by all),
gaps as (select doc_id, b as a, lead(a) over (partition by doc_id order by a) as b from runs union all select doc_id, 0, min(a) from runs group by doc_id),
kept as (select g.doc_id, string_agg(substr(d.h, cast(2 * g.a + 1 as bigint), cast(2 * (coalesce(g.b, length(d.h) // 2) - g.a) as bigint)), '' order by g.a) as k from gaps g join d on g.doc_id = d.doc_id group by g.doc_id),
n as (select doc_id, sum(b - a) as removed, count(*) as spans from runs group by doc_id)
select d.doc_id, cast(length(d.h) // 2 as bigint) as n_bytes, cast(coalesce(n.removed, 0) as bigint) as n_removed, cast(coalesce(n.spans, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(kept.k, d.h))) as kept_sha256
from d left join n on n.doc_id = d.doc_id left join kept on kept.doc_id = d.doc_id
"""


def spot_sets_sql(bodies: str) -> str:
    """CTE h (doc_id, kind, s): the sets of chains of content words behind common
    words, of the bodies of CTE t (doc_id, kind, body)."""
    from .spotsigs import ANCHORS

    common = "[" + ", ".join(f"'{w}'" for w in sorted(set(ANCHORS))) + "]"
    return rf"""
{bodies}
w as (select doc_id, kind, list_filter(regexp_split_to_array(lower(body), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '') as ws from t),
c as (select doc_id, kind, ws, list_filter(list_transform(ws, lambda x, i: {{'w': x, 'a': case when i > 1 and list_contains({common}, ws[i - 1]) then ws[i - 1] end}}), lambda s: not list_contains({common}, s.w)) as cs from w),
g as (select doc_id, kind, ws, list_filter(list_transform(cs, lambda s, i: case when s.a is not null then substr(md5(concat_ws(' ', s.a, s.w, cs[i + 1].w, cs[i + 2].w)), 1, 8) end), lambda x: x is not null) as found from c),
h as (select doc_id, kind, list_sort(list_distinct(case when len(found) > 0 then found else list_transform(ws, lambda x, i: substr(md5(concat_ws(' ', x, ws[i + 1], ws[i + 2])), 1, 8)) end)) as s from g)"""


def spots_sql() -> str:
    """Sets of the text, the edited text and the next text."""
    bodies = """with d as (select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id desc) as r from documents),
e as (select a.doc_id, a.text, coalesce(b.text, (select text from d where r = 1)) as next_text from d a left join d b on b.r = a.r + 1),
f as (select doc_id, text, next_text, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) as edited from e),
t as (select doc_id, 0 as kind, text as body from f union all select doc_id, 1, edited from f union all select doc_id, 2, next_text from f),"""
    return spot_sets_sql(bodies) + """,
p as (select f.doc_id, cast(length(f.text) as bigint) as n_chars, sha256(f.edited) as edited_sha256, a.s as x, b.s as y, n.s as z from f join h a on a.doc_id = f.doc_id and a.kind = 0 join h b on b.doc_id = f.doc_id and b.kind = 1 join h n on n.doc_id = f.doc_id and n.kind = 2)
select doc_id, n_chars, edited_sha256, array_to_string(x, '') as fingerprint, array_to_string(y, '') as edited_fingerprint,
       case when len(x) + len(y) = 0 then 1.0::double else len(list_intersect(x, y))::double / (len(x) + len(y) - len(list_intersect(x, y))) end as near_edited,
       case when len(x) + len(z) = 0 then 1.0::double else len(list_intersect(x, z))::double / (len(x) + len(z) - len(list_intersect(x, z))) end as near_next
from p
"""


def links_sql() -> str:
    """All pairs of sets that share a signature."""
    return spot_sets_sql("with t as (select doc_id, 0 as kind, coalesce(text, '') as body from documents),") + """,
k as (select doc_id, array_to_string(s, '') as print, s from h),
m as (select print, min(doc_id) as class, any_value(s) as s from k group by print),
u as (select class, len(s) as n, unnest(s) as spot from m where len(s) > 0),
p as (select a.class as a, b.class as b, count(*) as shared, any_value(a.n) as na, any_value(b.n) as nb from u a join u b on a.spot = b.spot and a.class < b.class group by all),
l as (select a, b from p where shared::double / (na + nb - shared) >= 0.8 - 1e-12),
n as (select class, count(*) as links from (select a as class from l union all select b from l) group by 1)
select k.doc_id, m.class, cast(coalesce(n.links, 0) as bigint) as links from k join m on m.print = k.print left join n on n.class = m.class
"""


#: Counts of each text, and lines in over 10 different texts and over 1 % of the
#: texts of their source.
FREQUENT_SQL = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as body, coalesce('+' || source, '-') as host from documents),
w as (select rid, body, host, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as ws from d),
win as (select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as s from (select rid, ws, unnest(generate_series(1, len(ws) - 2)) as i from w where len(ws) > 2)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, s) as k from win) where k > 1),
rep as (select rid, count(distinct i + j) as n from twice, (values (0), (1), (2)) o(j) group by rid),
l as (select rid, host, body, unnest(string_split(body, chr(10))) as line from d),
dup as (select rid, count(*) - count(distinct line) as n from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid),
m as (select rid, host, body, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) as s from l),
h as (select host, count(distinct body) as n from d group by host),
f as (select m.host, s from m join h on m.host = h.host where s <> '' group by m.host, s having count(distinct body) > 10 and count(distinct body) > 0.01 * any_value(h.n)),
g as (select rid, count(*) as lines, sum(len(string_split(s, ' '))) as words from m join f using (host, s) group by rid),
r as (select d.doc_id, len(ws) as n_words, len(array_to_string(ws, '')) as word_chars, length(d.body) - length(regexp_replace(d.body, '[#*$%&|<>]', '', 'g')) as n_symbols,
             coalesce(dup.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, coalesce(g.lines, 0) as n_removed_lines, coalesce(g.words, 0) as removed_words
      from d join w using (rid) left join dup using (rid) left join rep using (rid) left join g using (rid))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 2 * removed_words <= n_words as kept,
       cast(n_removed_lines as bigint) as n_removed_lines, cast(removed_words as bigint) as removed_words from r
"""


def centroids_sql(rounds: int = 5) -> str:
    """Every vector's squared distance to every centroid, round by round."""
    components = ", ".join(f"cast((s[{i}] - ((s[{i}] % n) + n) % n) // n as bigint)" for i in range(1, 65))
    distance = "cast(list_sum(list_transform(list_zip(v.e, c.m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint)"
    out = """with v as (select row_number() over () as rid, vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
 where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select row_number() over (order by sha256('2:' || vec_id)) - 1 as num, e as m from v order by sha256('2:' || vec_id) limit 40)"""
    for k in range(rounds + 1):
        out += f""",
d{k} as (select v.rid, v.vec_id, c.num, {distance} as d from v, c{k} c),
a{k} as (select rid, vec_id, num, d from (select *, row_number() over (partition by rid order by d, num) as k from d{k}) where k = 1)"""
        if k < rounds:
            sums = ", ".join(f"sum(v.e[{i}])" for i in range(1, 65))
            out += f""",
s{k} as (select a.num, count(*) as n, [{sums}] as s from a{k} a join v using (rid) group by a.num),
c{k + 1} as (select c.num, case when s.n is null then c.m else [{components}] end as m from c{k} c left join s{k} s using (num))"""
    return out + f"""
select a.vec_id, cast(a.num as integer) as cluster, a.d as distance, cast(sum(a.d) over (partition by a.num) as bigint) as cluster_inertia, cast(sum(a.d) over () as bigint) as inertia,
       sha256(array_to_string(c.m, ',')) as centroid_sha256 from a{rounds} a join c{rounds} c using (num)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": TOP_K_SQL, "op6_suffixes": REPEATS_SQL, "op9_spotsigs": spots_sql(), "spotsigs_links": links_sql(), "op10_lines": LINES_SQL, "op11_linefreq": FREQUENT_SQL, "op12_centroids": centroids_sql()}
