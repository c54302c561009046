"""One query per operator, over the whole of its table, with production
parameters; and the DuckDB SQL for the rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitpack, chunk_dedup, concat_cut, conversation_repair, license_scan, line_dedup, merkle, mixing, packing, quality, secret_scan, simhash, token_files
from .util import documents

#: Vocabulary files of public tokenizers, and the end id of flat token files.
def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


WORD_BPE, BYTE_BPE, FLAT_END_ID = "word_bpe_49k.json", "byte_bpe_50k.json", 49407

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


@query()
def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_counts(documents(spark, sf_dir), vocabulary(WORD_BPE), FLAT_END_ID)


def _license_sql() -> str:
    """The canonical form by the same rules, and the known texts as values.
    Lines that name a holder are told line by line, as this engine's patterns
    do not look ahead: what must follow, and what must not."""
    after, not_holder, not_item = r"[\p{L}\p{N}<\[{]", license_scan.NO_HOLDER, license_scan.NO_ITEM
    forms = [(r"copyright[ \t]*[:,]?[ \t]*", rf"(?:\(c\)|©|{after})", not_holder),
             (r"(?:\(c\)|©)[ \t]*copyright[ \t]+", after, rf"(?:{not_item}|{not_holder})"), (r"(?:\(c\)|©)[ \t]*", after, rf"(?:{not_item}|{not_holder})")]
    holder = " or ".join(rf"(regexp_matches(x, '^{license_scan.MARKS}{head}{yes}') and not regexp_matches(x, '^{license_scan.MARKS}{head}{no}'))"
                         for head, yes, no in forms)

    def canonical(x: str) -> str:
        x = f"array_to_string([case when {holder} then ' ' else x end for x in string_split(lower(coalesce({x}, '')), chr(10))], chr(10))"
        x = rf"' ' || trim(regexp_replace({x}, '[^\p{{L}}\p{{N}}]+', '  ', 'g'), ' ') || ' '"
        for old, new in license_scan.SPELLINGS:
            x = f"replace({x}, ' {old} ', ' {new} ')"
        return f"trim(replace({x}, '  ', ' '), ' ')"

    texts = [*license_scan.TEXTS.items(), *((k, n.format(name)) for k, names in license_scan.NAMES.items() for name in names for n in license_scan.NOTICES)]
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in texts)
    return f"""
with k as (select sha256(c) s, min(i) license_id from (select i, {canonical('t')} c from (values {values}) v(i, t)) where c != '' group by 1),
d as (select row_number() over () r, doc_id, text from documents),
l as (select r, count(*) n, string_agg(distinct license_id, ',' order by license_id) names
  from (select r, sha256({canonical('t')}) s from (select r, unnest(string_split(text, chr(10))) t from d)) join k using (s) group by r)
select doc_id, d.s canonical_sha256, k.license_id, coalesce(n, 0)::bigint n_license_lines, coalesce(names, '') line_licenses
from (select *, sha256({canonical('text')}) s from d) d left join k using (s) left join l using (r)"""


@query(_license_sql())
def op2_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), vocabulary(WORD_BPE))


#: Per-text counts and the line-frequency verdict; {docs} is a table expression.
QUALITY_SQL = r"""
d as (select row_number() over () r, doc_id, source, coalesce(text, '') t from {docs}),
w as (select r, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) w, generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) i from d),
win as (select r, i, w, lead(w) over o w2, lead(w, 2) over o w3 from w window o as (partition by r order by i)),
rep as (select r, i from (select *, count(*) over (partition by r, w, w2, w3) c from win where w3 is not null) where c >= 2),
cov as (select r, count(distinct i) n from (select r, i from rep union all select r, i + 1 from rep union all select r, i + 2 from rep) group by r),
wc as (select r, count(*) n_words, sum(length(w)) word_chars from w group by r),
l as (select r, unnest(string_split(t, chr(10))) l from d),
lw as (select r, l, trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) k
       from l where regexp_matches(l, '[^\x20\x09-\x0D]')),
dl as (select r, count(*) - count(distinct l) n from lw group by r),
ht as (select source, count(distinct t) n from d group by source),
often as (select d.source, k from lw join d using (r) group by d.source, k
          having count(distinct t) > 20 and count(distinct t) > (select least(0.01 * n, 100) from ht where ht.source is not distinct from d.source)),
gone as (select r, sum(length(k) - length(replace(k, ' ', '')) + 1) n from lw join d using (r)
         where exists (select 1 from often o where o.k = lw.k and o.source is not distinct from d.source) group by r),
judged as (select d.r, d.doc_id, coalesce(n_words, 0) n_words, coalesce(word_chars, 0) word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols, coalesce(dl.n, 0) n_dup_lines, coalesce(cov.n, 0) n_repeat_words,
    coalesce(n_words, 0) < 50 or 100 * coalesce(cov.n, 0) > 50 * coalesce(n_words, 0) base_failed, coalesce(gone.n, 0) removed_words
  from d left join wc using (r) left join dl using (r) left join cov using (r) left join gone using (r))
"""


@query("with " + QUALITY_SQL.format(docs="documents") + """
select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols, n_dup_lines::bigint n_dup_lines,
  n_repeat_words::bigint n_repeat_words, base_failed, removed_words::bigint removed_words,
  not base_failed and n_words - removed_words >= 0.5 * n_words kept from judged""")
def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


#: Targets of sources and what is taken; {docs} is a table expression.
MIXING_SQL = r"""
s as (select row_number() over () r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
    (('0x' || substr(md5('mix-1|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 u
  from {docs}),
sw as (select *, case when size < 50 then 1 else 2 end w from s),
per as (select source, sum(size)::bigint source_size from sw group by source),
pw as (select *, [3.0::double, 1.0::double, 2.0::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] sw, source_size::double * 2 stop from per),
lv as (select *, (sum(source_size) over ()::double * 1.5::double - coalesce(sum(stop) over (o rows between unbounded preceding and 1 preceding), 0.0::double))
    / sum(sw) over (o rows between current row and unbounded following) lev from pw window o as (order by stop / sw, source nulls last)),
fr as (select *, lev * sw < stop free from lv),
tg as (select source, source_size, case when free then (min(case when free then stop / sw end) over ()) * 0 + (
    select lev from fr f where f.free order by f.stop / f.sw, f.source nulls last limit 1) * sw else stop end target from fr),
g as (select source, w, sum(size)::bigint words from sw group by source, w),
gc as (select g.source, g.w, words, source_size, target,
    (target - 2 * coalesce(sum(words) over (o rows between unbounded preceding and 1 preceding), 0)::double)
      / nullif(sum(words * g.w) over (o rows between current row and unbounded following), 0)::double c
  from g join tg on g.source is not distinct from tg.source window o as (partition by g.source order by g.w desc)),
gf as (select *, c * w < 2 free from gc),
gx as (select *, case when words = 0 then 0.0::double when free then
    first_value(case when free then c end ignore nulls) over (partition by source order by w desc rows between unbounded preceding and unbounded following) * w
    else 2.0::double end copies from gf),
gp as (select *, floor(copies) certain, copies - floor(copies) p, target - (sum(floor(copies) * words) over (partition by source)) remaining from gx),
rk as (select sw.*, gp.source_size, target, certain, remaining, case when p > 0 and size > 0 then (u / (1 - u)) * ((1 - p) / p) end rank
  from sw join gp on sw.source is not distinct from gp.source and sw.w = gp.w),
cu as (select *, coalesce(sum(case when rank is not null then size end) over (partition by source order by rank nulls last, doc_id nulls first, r
    rows between unbounded preceding and 1 preceding), 0) before from rk),
mixed as (select r, doc_id, size, source_size, target, case when size = 0 then 0 else
    certain + case when rank is not null and 2 * before + size <= 2 * remaining then 1 else 0 end end::bigint copies from cu)
"""


@query("with " + MIXING_SQL.format(docs="documents") + """
select doc_id, size, source_size, target, (copies * size)::bigint taken, copies from mixed""")
def op5_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("row")


@query()
def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = line_dedup.deduped(docs, counts=("n_lines", "n_removed"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query()
def op7_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(documents(spark, sf_dir)).drop("row", "component")


@query()
def op8_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.packed(documents(spark, sf_dir), vocabulary(BYTE_BPE))


@query()
def op9_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


@query("""
select doc_id, max(doc_id) over g keep_id, count(*) over g group_size, doc_id = max(doc_id) over g kept, sha256(coalesce(text, '')) text_sha256
from documents window g as (partition by coalesce(text, ''))""")
def op10_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.dedup_exact(documents(spark, sf_dir)).drop("n_chunks")


@query()
def op12_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_cut.packed(documents(spark, sf_dir), vocabulary(WORD_BPE))


def without_line_ends(text, doc_id):
    """The tampering that the query of op11 detects: line ends gone from texts whose
    id has an even CRC-32."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def _crc32_sql(x: str) -> str:
    """CRC-32 of a text's ASCII characters, bit by bit."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, [ord(y)::bigint for y in string_split({x}, '')]), lambda c, b: {step}), 4294967295::bigint)"


def _merkle_sql() -> str:
    """The levels by one recursion per tree, their siblings, and the climb by another."""
    def leaf(text: str) -> str:
        told = [f"case when {c} is null then '-' else strlen({c}::varchar)::varchar || ':' || {c}::varchar end" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(told)})"

    def siblings(levels: str) -> str:
        return f"""select a.g, a.k, a.i, a.n, coalesce(string_agg(b.h, '' order by b.i) filter (b.i < a.i), '') l, coalesce(string_agg(b.h, '' order by b.i) filter (b.i > a.i), '') r
  from {levels} a left join {levels} b on a.g = b.g and a.k = b.k and a.i // 3 = b.i // 3 and a.i != b.i where a.n > 1 group by all"""

    return f"""
with recursive d as (select *, case when {_crc32_sql("coalesce(doc_id::varchar, '-')")} % 2 = 0 and doc_id is not null then replace(text, chr(10), '') else text end now from documents),
f as (select row_number() over () r, doc_id, source, {leaf("text")} leaf, {leaf("now")} now from d),
o as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 i, count(*) over (partition by source) n,
  dense_rank() over (order by source nulls first) - 1 g from f),
lv as (select g, 0 k, i, n, leaf h from o union all select g, k + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i)) from lv where n > 1 group by g, k, i // 3, n),
s as (select g, h subroot from lv where n = 1),
tv as (select -1::bigint g, 0 k, g i, count(*) over () n, subroot h from s
  union all select g, k + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i)) from tv where n > 1 group by g, k, i // 3, n),
sb as (select g, k, i, l, r, case when n <= 3 then -1 else g end pg, case when n <= 3 then 0 else k + 1 end pk, case when n <= 3 then g else i // 3 end pi from ({siblings("lv")})
  union all select g, k, i, l, r, g, k + 1, i // 3 from ({siblings("tv")})),
c as (select r, 0 step, now folded, '' proof, case when n = 1 then -1 else g end g, 0 k, case when n = 1 then g else i end i from o
  union all select c.r, step + 1, sha256(sb.l || folded || sb.r), proof || sb.l || sb.r, pg, pk, pi from c join sb on c.g = sb.g and c.k = sb.k and c.i = sb.i),
t as (select r, arg_max(folded, step) folded, arg_max(proof, step) proof from c group by r),
root as (select h from tv where n = 1)
select doc_id, leaf, subroot, h root, sha256(proof) proof_sha256, folded folded_root, folded = h verified from o join s using (g) join t using (r), root"""


@query(_merkle_sql())
def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = {"text": without_line_ends(F.col("text"), F.col("doc_id"))}
    return merkle.verified(documents(spark, sf_dir), ["doc_id", "source", "lang", "n_chars", "text"], found)


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage that the query of op13 repairs, by the CRC-32 of ``conv_id:turn``: a
    row is dropped, emptied, robbed of its sentence ends, repeated, or the user's."""
    told = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    rows = conversations.withColumn("kind", F.crc32(F.concat(told["conv_id"], F.lit(":"), told["turn"]).cast("binary")) % 20).where("kind != 0")
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(told["text"], "[.!?]", "")).otherwise(told["text"])
    times = F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy")
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(told["role"]).alias("role"), text.alias("text"), times).drop("copy")


def _repair_sql() -> str:
    """The damage, the faults, and the cheapest audit-least edits by a recursion that
    keeps the best (cost, audit) of each row and role-string end."""
    key = _crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")
    return f"""
with recursive k as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text, {key} % 20 kind from conversations),
dam as (select conv_id, turn, case when kind = 4 then 'user' else role end role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text, unnest(range(case when kind = 3 then 2 else 1 end)) copy from k where kind != 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, substr(text, 1, 32), md5(text)) pos, left(role, 1) ini,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) final from dam),
r as (select *, case when final = '' then 'blank' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
    when final not in ('.', '!', '?') then 'truncated' end fault, lag(ini) over (partition by conv_id order by pos) before from o),
ins(p, n, q, put) as (values ('', 0, '', []::varchar[]), ('', 1, 'u', ['user:']), ('', 2, 'a', ['user:', 'assistant:']), ('s', 0, 's', []), ('s', 1, 'u', ['user:']),
    ('s', 2, 'a', ['user:', 'assistant:']), ('u', 0, 'u', []), ('u', 1, 'a', ['assistant:']), ('u', 2, 'u', ['assistant:', 'user:']), ('a', 0, 'a', []),
    ('a', 1, 'u', ['user:']), ('a', 2, 'a', ['user:', 'assistant:'])),
ops(q, op, next) as (values ('', 'D', ''), ('s', 'D', 's'), ('u', 'D', 'u'), ('a', 'D', 'a'), ('', 'K', 's'), ('', 'K', 'u'), ('s', 'K', 'u'), ('u', 'K', 'a'), ('a', 'K', 'u'),
    ('', 'R', 'u'), ('s', 'R', 'u'), ('u', 'R', 'a'), ('a', 'R', 'u')),
step as (select p, n, put, op, next from ins join ops using (q)),
dp as (select distinct conv_id, 0 m, '' q, {{'c': 0, 'a': '', 'r': []::varchar[]}} b from r
  union all select dp.conv_id, m + 1, next, min({{'c': b.c + 2 * n + case op when 'D' then 3 else 2 * (op = 'R')::int + coalesce((fault = 'truncated')::int, 0) end,
      'a': b.a || repeat('I', n) || op, 'r': b.r || put || case op when 'D' then []::varchar[] when 'K' then [role || ':' || text]
        else [case next when 'u' then 'user:' else 'assistant:' end || text] end}})
    from dp join r on r.conv_id is not distinct from dp.conv_id and pos = m + 1 join step on p = q
    where op = 'D' or (coalesce(fault, '') not in ('blank', 'duplicate') and (op = 'R' or next = ini)) group by dp.conv_id, m, next),
e as (select conv_id, min({{'c': b.c + case q when 's' then 4 when 'u' then 2 else 0 end, 'a': b.a || case q when 's' then 'II' when 'u' then 'I' else '' end,
    'r': b.r || case q when 's' then ['user:', 'assistant:'] when 'u' then ['assistant:'] else []::varchar[] end}}) b
  from dp where m = (select count(*) from r where r.conv_id is not distinct from dp.conv_id) group by conv_id),
n as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
    count(*) filter (fault = 'truncated') truncated, count(*) filter (before is not null and before || ini not in ('su', 'ua', 'au')) illegal from r group by conv_id)
select i.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate, coalesce(truncated, 0)::bigint truncated,
  coalesce(illegal, 0)::bigint illegal, coalesce(b.c, 0)::bigint cost, coalesce(b.a, '') audit, sha256(coalesce(array_to_string(b.r, chr(10)), '')) repaired_sha256
from (select distinct conv_id from conversations) i left join n on n.conv_id is not distinct from i.conv_id left join e on e.conv_id is not distinct from i.conv_id"""


@query(_repair_sql())
def op13_hirschberg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.Repair(damaged(rows)).report(rows)
