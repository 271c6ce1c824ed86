"""Registered queries of the operators: each applies one operator, with production
parameters, to its whole table and derives the contract's columns from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, html_extract, language_id, line_dedup, line_rules, merkle, packing, quality,
               secrets, simhash, spelling, weighted_sampling)
from .common import crc_mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 3) == 1)
    labels, profile = language_id.prototypes(docs, train=~docs["held_out"])
    return language_id.predict(docs, labels, profile, keep=("doc_id", "held_out"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the text that is left of it and the (start, end) removed from the original."""
    left = line_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["end"]))
    return left.select("doc_id", "text", F.size("removed").cast("bigint").alias("n_removed"), F.array_join(spans, ",").alias("removed"))


def op5_line_dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removed units one by one, each with its earliest occurrence."""
    found = line_dedup.repeated_units(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "unit", "start", "end", "first_doc_id", "first_unit")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(found["fp"]).alias("fingerprint"), "component_id")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.conversation_digests(rows)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.document_statistics(table(spark, sf_dir, "documents"))
    stats = stats.withColumn("held_out", crc_mod("doc_id", 5) == 0)
    model = quality.fit(stats, table(spark, sf_dir, "labels"), train=~stats["held_out"])
    return quality.score(stats, model, keep=("doc_id", "held_out"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.near_next(table(spark, sf_dir, "documents"))


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_rules.evaluate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        "lost_chars", "n_punctuation", "n_navigation", "n_boilerplate")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"), tampered=crc_mod("doc_id", 5) == 0)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_language_id": op2_language_id,
    "op3_html_extraction": op3_html_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op5_line_dedup_all": op5_line_dedup_all,
    "op6_simhash": op6_simhash,
    "op7_chat_format": op7_chat_format,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_weighted_sampling": op10_weighted_sampling,
    "op11_line_rules": op11_line_rules,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}

# crc32 of a list of bytes, by its table (made here by the polynomial's rule)
_CRC_TABLE = """
crc as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
           case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t)"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, {0}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""
_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _line_rules_sql() -> str:
    """Lines and five-word windows as rows; the rules as conditions on a line."""
    phrases = " or ".join(f"contains(low, '{p}')" for p in line_rules.PHRASES)
    space = r"[\x20\x09-\x0D]"
    return rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (
  select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from d),
p as (
  select r, k, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2] || ' ' || words[k + 3] || ' ' || words[k + 4] as gram
  from (select r, words, unnest(range(1, len(words) - 3)) as k from w)),
often as (
  select r, k, lag(k) over (partition by r order by k) as before
  from (select r, k, count(*) over (partition by r, gram) as n from p) where n > 1),
repeated as (select r, sum(least(5, k - coalesce(before, -5))) as n_repeat_words from often group by r),
l as (
  select r, k, lines[k] as line, translate(lines[k], {_CAPITALS}) as low,
         len(regexp_extract_all(lines[k], '[^\x20\x09-\x0D]+')) as n,
         length(regexp_replace(lines[k], '{space}', '', 'g')) as chars
  from (select r, lines, unnest(range(1, len(lines) + 1)) as k from (select r, string_split(text, chr(10)) as lines from d))),
v as (
  select *, k > min(k) over (partition by r, line) as dup,
         len(regexp_extract_all(line, '[|»›•·]')) as seps,
         len(regexp_extract_all(line, '[#*$%&|<>]')) as symbols,
         len(regexp_extract_all(line, '[!?]{{2,}}')) as marks,
         regexp_matches(line, '[.!?…][)\]"''”’»]*({space}|$)') as ends
  from l where n > 0),
x as (
  select *, case when seps >= 2 and n <= 5 * (seps + 1) then 'navigation'
                 when 5 * symbols > n or 10 * marks > n or not ends then 'punctuation'
                 when {phrases} then 'boilerplate' end as rule
  from v),
s as (
  select r, sum(chars) as word_chars, sum(n) as n_words, count(*) filter (dup) as n_dup_lines,
         coalesce(sum(chars) filter (rule is not null), 0) as lost,
         count(*) filter (rule = 'punctuation') as n_punctuation, count(*) filter (rule = 'navigation') as n_navigation,
         count(*) filter (rule = 'boilerplate') as n_boilerplate
  from x group by r),
b as (
  select d.doc_id, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_words, 0) as n_words,
         coalesce(word_chars, 0) as word_chars, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(lost, 0) as lost,
         coalesce(n_punctuation, 0) as n_punctuation, coalesce(n_navigation, 0) as n_navigation,
         coalesce(n_boilerplate, 0) as n_boilerplate
  from d left join s using (r) left join repeated using (r)),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from b)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and 2 * lost <= word_chars as kept, cast(lost as bigint) as lost_chars,
       n_punctuation, n_navigation, n_boilerplate
from f"""


def _merkle_sql(levels: int = 6) -> str:
    """Trees of up to 16 ** ``levels`` nodes, level by level; a node's siblings by a window."""
    def code(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def tree(name: str, bottom: str) -> list[str]:
        out = [f"{name}0 as ({bottom})"]
        for k in range(levels):
            run = "partition by tree, pos // 16 order by pos rows between"
            out.append(f"""{name}s{k} as (
  select tree, pos, h, n > 1 as live, coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l,
         coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r from {name}{k})""")
            out.append(f"""{name}{k + 1} as (
  select tree, pos // 16 as pos, (any_value(n) + 15) // 16 as n,
         case when any_value(n) > 1 then sha256(string_agg(h, '' order by pos)) else min(h) end as h
  from {name}{k} group by tree, pos // 16)""")
        return out

    def path(name: str, rows: str, out: str) -> list[str]:
        """Proof and folded hash carried up one tree."""
        steps = [f"{out}0 as (select * from {rows})"]
        for k in range(levels):
            steps.append(f"""{out}{k + 1} as (
  select q.* exclude (proof, folded, place), q.place // 16 as place,
         case when s.live then proof || s.l || s.r else proof end as proof,
         case when s.live then sha256(s.l || folded || s.r) else folded end as folded
  from {out}{k} q join {name}s{k} s on s.tree is not distinct from q.tree and s.pos = q.place)""")
        return steps

    digits = "list_transform(regexp_extract_all(coalesce(cast(doc_id as varchar), ''), '.'), lambda x: cast(ord(x) as bigint))"
    fields = " || ".join(code(f"cast({c} as varchar)") for c in ("doc_id", "source", "lang", "n_chars"))
    parts = [_CRC_TABLE.strip(), f"""
d as (
  select doc_id, source, sha256({fields} || {code('text')}) as leaf,
         sha256({fields} || {code(f'translate(text, {_CAPITALS})')}) as lowered,
         {_CRC.format(digits)} % 5 = 0 as tampered
  from documents, crc)""", """
o as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place,
         count(*) over (partition by source) as n from d)"""]
    parts += tree("a", "select source as tree, place as pos, n, leaf as h from o")
    parts += ["""
tops as (
  select tree as source, h as subroot, row_number() over (order by tree nulls first) - 1 as place, count(*) over () as n
  from a%d)""" % levels]
    parts += tree("b", "select 0 as tree, place as pos, n, subroot as h from tops")
    parts += path("a", "(select doc_id, source as tree, leaf, place, '' as proof, case when tampered then lowered else leaf end as folded from o)", "p")
    parts += ["""
mid as (
  select doc_id, leaf, subroot, 0 as tree, tops.place, proof, folded
  from p%d p join tops on p.tree is not distinct from tops.source)""" % levels]
    parts += path("b", "mid", "q")
    return "with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroot, b.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = b.h as verified
from q{levels} q, b{levels} b"""


def _spelling_sql() -> str:
    """Near words by what is left of a word without one code point, at the same place (replaced)
    or as the other word itself (inserted, deleted)."""
    # the letters are ASCII or U+00C0 to U+00FF, whose second byte is the code point less 64
    bytes_of = ("flatten(list_transform(regexp_extract_all({0}, '.'), lambda x: case when ord(x) < 128 "
                "then [cast(ord(x) as bigint)] else [195, cast(ord(x) - 64 as bigint)] end))")
    return f"""
with recursive {_CRC_TABLE.strip()},
runs as (
  select doc_id, run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(translate(text, {_CAPITALS}), '[A-Za-zÀ-ÿ]+')) as run from documents)
  where length(run) >= 7 group by all),
hashed as (
  select run, n, {_CRC.format(bytes_of.format("coalesce(cast(doc_id as varchar), '') || ':' || run"))} as h
  from runs, crc),
said as (
  select case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed),
words as (
  select word, cast(sum(n) as bigint) as n from said where length(word) >= 7 group by word having sum(n) >= 2),
less as (
  select word, n, k, left(word, k - 1) || substr(word, k + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as k from words)),
near as (
  select a.word, b.word as near, b.n as near_n from less a join less b on a.rest = b.rest and a.k = b.k and a.word <> b.word
  union
  select a.word, b.word, b.n from less a join words b on a.rest = b.word
  union
  select b.word, a.word, a.n from less a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, min({{'less': -near_n, 'near': near}}) as best from near group by word),
forms as (
  select word, n, coalesce(n_near, 0) as n_near, case when -best.less >= 10 * n then best.near end as form,
         case when -best.less >= 10 * n then -best.less end as form_n
  from words left join best using (word)),
walk as (
  select word, word as last from words
  union all
  select walk.word, forms.form from walk join forms on walk.last = forms.word where forms.form is not null)
select f.word, f.form, w.last as root, f.n, f.n_near, f.form_n
from forms f join walk w on f.word = w.word join forms e on e.word = w.last and e.form is null"""



# Exact containment of all pairs: distinct five-word shingles of items (fewer words: all of
# them) looked for among the documents' shingles.
ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": r"""
with d as (
  select distinct doc_id, [x for x in string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+') if x <> ''] as w
  from documents),
i as (
  select distinct item_id, [x for x in string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+') if x <> ''] as w
  from benchmark),
n as (select item_id, w, least(len(w), 5) as size from i where len(w) > 0),
si as (
  select distinct item_id, w, size, array_to_string(w[k:k + size - 1], ' ') as s
  from (select *, unnest(range(1, len(w) - size + 2)) as k from n)),
sd as (
  select distinct doc_id, w, size, array_to_string(w[k:k + size - 1], ' ') as s
  from (select d.*, size, unnest(range(1, len(w) - size + 2)) as k
        from d cross join (select distinct size from n) where len(w) >= size)),
c as (select item_id, w, count(*) as n_shingles from si group by all)
select sd.doc_id, si.item_id, cast(any_value(c.n_shingles) as integer) as n_shingles,
       cast(count(*) as integer) as n_shared, count(*) / any_value(c.n_shingles) as containment
from si join sd on si.s = sd.s and si.size = sd.size
join c on c.item_id is not distinct from si.item_id and c.w = si.w
group by sd.doc_id, sd.w, si.item_id, si.w
having count(*) / any_value(c.n_shingles) >= 0.8
""",
    # the lines that are not a later occurrence, each with the line break after it
    "op5_line_dedup": r"""
with d as (
  select doc_id, text, md5(text) as h, string_split(text, chr(10)) as lines
  from (select distinct doc_id, text from documents where text is not null)),
u as (
  select doc_id, h, k, lines[k] as line, len(lines) as last,
         coalesce(list_sum([length(x) + 1 for x in lines[1:k - 1]]), 0) as start,
         trim(regexp_replace(lower(lines[k]), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm
  from (select *, unnest(range(1, len(lines) + 1)) as k from d)),
p as (
  select *, norm <> '' and row_number() over (partition by norm order by doc_id nulls last, h, k) > 1 as gone from u),
a as (
  select doc_id, h, string_agg(case when gone then '' else line || case when k < last then chr(10) else '' end end, '' order by k) as text,
         count(*) filter (gone) as n_removed,
         string_agg(cast(start as bigint) || ':' || cast(start + length(line) as bigint), ',' order by k) filter (gone) as removed
  from p group by doc_id, h)
select d.doc_id, case when d.text is null then null else a.text end as text, coalesce(a.n_removed, 0) as n_removed,
       coalesce(a.removed, '') as removed
from documents d left join a on a.doc_id is not distinct from d.doc_id and a.h = md5(d.text)
""",
    # every line that is not empty, beside the earliest of its group
    "op5_line_dedup_all": r"""
with d as (
  select doc_id, text, md5(text) as h, string_split(text, chr(10)) as lines
  from (select distinct doc_id, text from documents where text is not null)),
u as (
  select doc_id, h, k - 1 as unit, lines[k] as line,
         coalesce(list_sum([length(x) + 1 for x in lines[1:k - 1]]), 0) as start,
         trim(regexp_replace(lower(lines[k]), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm
  from (select *, unnest(range(1, len(lines) + 1)) as k from d)),
g as (
  select norm, min({'no_id': doc_id is null, 'id': coalesce(doc_id, 0), 'h': h, 'unit': unit}) as best
  from u where norm <> '' group by norm having count(*) > 1)
select u.doc_id, u.unit, cast(u.start as bigint) as start, cast(u.start + length(u.line) as bigint) as "end",
       case when g.best.no_id then null else g.best.id end as first_doc_id, g.best.unit as first_unit
from u join g using (norm)
where not (u.doc_id is null = g.best.no_id and coalesce(u.doc_id, 0) = g.best.id and u.h = g.best.h and u.unit = g.best.unit)
""",
    "op11_line_rules": _line_rules_sql(),
    "op12_spelling_variants": _spelling_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}
