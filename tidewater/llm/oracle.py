"""DuckDB SQL for the training-data queries that SQL can express (exact joins and windows)."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op2_chosen_path": r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
s as materialized (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as materialized (
  select a.doc_id as a, b.doc_id as b
  from s a join s b on a.g = b.g and a.doc_id < b.doc_id
  join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having count(*) >= 0.8 * (x.n + y.n - count(*))),
q as materialized (select a, b from p union all select b, a from p),
reach(a, b) as (
  select doc_id, doc_id from documents union select r.a, q.b from reach r join q on r.b = q.a)
select doc_id, c.class_id, coalesce(k.n_links, 0) as n_links
from documents join (select a, min(b) as class_id from reach group by a) c on c.a = doc_id
left join (select a, count(*) as n_links from q group by a) k on k.a = doc_id""",
    "op6_caps": """
with recursive e as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
p as materialized (
  select a.vec_id as a, b.vec_id as b from e a join e b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) as (
  select vec_id, vec_id from e union select r.a, p.b from reach r join p on r.b = p.a)
select vec_id, (select count(*) from p where p.a = vec_id) as n_links, c.component_id,
       vec_id = c.component_id as kept
from e join (select a, min(b) as component_id from reach group by a) c on c.a = e.vec_id""",
    "op8_recompress": r"""
with d as (
  select row_number() over () as r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
g as (
  select r, doc_id, i, sha256(array_to_string(list_slice(w, i, i + 12), ' ')) as g
  from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13)),
f as (select g, min(doc_id) as first from g group by g),
c as (
  select distinct r, i + k as p
  from g join f using (g), unnest(range(13)) t(k)
  where g.doc_id > f.first),
x as (
  select d.r, d.doc_id, d.w, p.i, c.p is not null as gone
  from d, unnest(range(1, len(d.w) + 1)) p(i) left join c on c.r = d.r and c.p = p.i),
k as (
  select r, count(*) filter (where gone) as n_removed, string_agg(w[i], ' ' order by i) filter (where not gone) as kept
  from x group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(k.n_removed, 0) as n_removed,
       sha256(coalesce(k.kept, '')) as kept_sha256
from d left join k using (r)""",
}


#: The words of all texts: (r, doc_id, w); ``r`` numbers the rows.
_WORDS = r"""
d as materialized (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents)"""


def _crc32(text: str) -> str:
    """crc32 of the ASCII characters of ``text``, bit by bit."""
    byte = ("list_reduce(list_concat([xor(c, b)], list_resize([]::bigint[], 8, 0)), "
            "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))")
    return (f"xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split({text}, ''), "
            f"lambda ch: ascii(ch)::bigint)), lambda c, b: {byte}))")


def _gram(n: int) -> str:
    """The next ``n`` words as one text; null where a document ends before."""
    return " || ' ' || ".join(["x", *[f"lead(x, {k}) over o" for k in range(1, n)]])


ORACLE["op11_repetition"] = rf"""
with {_WORDS},
x as materialized (select r, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from d),
grams as materialized (
  select r, i, 3 as n, {_gram(3)} as g from x window o as (partition by r order by i)
  union all
  select r, i, 10 as n, {_gram(10)} as g from x window o as (partition by r order by i)),
windows as materialized (
  select r, i, n, g from grams join (
    select r, n, g from grams where g is not null group by r, n, g having count(*) > 1) using (r, n, g)),
marked as (
  select distinct r, n, i + k as i from windows, unnest(range(n)) t(k)),
cover as (
  select r, count(*) filter (where n = 3) as n_repeat_words, count(*) filter (where n = 10) as covered_words,
         coalesce(sum(length(x)) filter (where n = 10), 0) as covered_chars
  from marked join x using (r, i) group by r),
tens as materialized (select r, i, g from windows where n = 10),
steps as (
  select a.r, b.i - a.i as far, a.i - row_number() over (partition by a.r, b.i - a.i order by a.i) as island
  from tens a join tens b on a.r = b.r and a.g = b.g and a.i < b.i),
longest as (
  select r, max(m) + 9 as longest_repeat from (select r, count(*) as m from steps group by r, far, island) group by r),
base as (
  select r, doc_id, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines
  from (select *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d)),
a as (
  select base.*, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(covered_words, 0) as covered_words,
         cast(coalesce(covered_chars, 0) as bigint) as covered_chars, coalesce(longest_repeat, 0) as longest_repeat,
         n_words < 50 or 100 * coalesce(n_repeat_words, 0) > 50 * n_words as base_failed
  from base left join cover using (r) left join longest using (r))
select * exclude (r), not (base_failed or 100 * covered_chars > 25 * word_chars
                           or (longest_repeat > 50 and 100 * longest_repeat > 15 * n_words)) as kept
from a"""


def _merkle_sql(height: int = 8) -> str:
    """``height`` levels for the sources and as many for the root: 16 ** height leaves of a source."""
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    whole = " || ".join(field(c) for c in fields)
    other = " || ".join(field(f"translate(text, '{upper}', '{lower}')" if c == "text" else c) for c in fields)
    parts = [f"""rows as materialized (
  select doc_id, source, sha256({whole}) as leaf,
         case when coalesce({_crc32("doc_id::varchar")} % 5 = 0, false) then sha256({other}) else sha256({whole}) end as shown
  from documents),
a0 as materialized (
  select coalesce('=' || source, '') as tree, leaf as digest, doc_id, shown,
         row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx from rows)"""]

    def climb(name: str) -> None:
        for k in range(1, height + 1):
            parts.append(f"""{name}{k} as materialized (
  select tree, idx // 16 as idx, list(digest order by idx) as run,
         case when max(n) = 1 then any_value(digest) else sha256(string_agg(digest, '' order by idx)) end as digest
  from (select *, count(*) over (partition by tree) as n from {name}{k - 1}) group by tree, idx // 16)""")

    climb("a")
    parts.append(f"""b0 as materialized (
  select 0 as tree, tree as of, digest, row_number() over (order by tree) - 1 as idx from a{height})""")
    climb("b")

    def steps(name: str, key: str, start: str, place: str) -> list[str]:
        """Names of successive relations that add one level's siblings and fold the digests."""
        last = start
        for k in range(1, height + 1):
            at, slot = f"{place} // {16 ** k}", f"cast({place} // {16 ** (k - 1)} % 16 as int)"
            lone = f"len(x.run) = 1 and (select count(*) from {name}{k - 1} y where y.tree = x.tree) = 1"
            parts.append(f"""{name}p{k} as (
  select p.* replace (
    p.path || case when lone then '' else array_to_string(list_concat(run[:{slot}], run[{slot} + 2:]), '') end as path,
    case when lone then p.now
         else sha256(array_to_string(list_concat(run[:{slot}], [p.now], run[{slot} + 2:]), '')) end as now)
  from {last} p join (select x.tree, x.idx, x.run, {lone} as lone from {name}{k} x) z
    on z.tree = p.{key} and z.idx = p.{at})""")
            last = f"{name}p{k}"
        return [last]

    parts.append("""start as (
  select a0.doc_id, a0.digest as leaf, a0.tree, a0.idx as own, b0.idx as of_idx, 0 as top, b0.digest as subroot,
         '' as path, a0.shown as now
  from a0 join b0 on b0.of = a0.tree)""")
    last = steps("a", "tree", "start", "own")[0]
    last = steps("b", "top", last, "of_idx")[0]
    return f"""with {", ".join(parts)}
select doc_id, leaf, subroot, root, sha256(path) as proof_sha256, now as folded_root, now = root as verified
from {last}, (select digest as root from b{height})"""


ORACLE["op12_merkle"] = _merkle_sql()

ORACLE["op13_runs"] = rf"""
with {_WORDS},
h as (select r, doc_id, w, len(w) as n, {_crc32("coalesce(doc_id::varchar, 'none')")} as h, doc_id is not null as known from d),
cut as (
  select *, case when n > 0 then (h // 10) % n end as a from h),
turned as (
  select *, case when n > 0 then 1 + (n - a) // (3 + (h // 10) % 8) end as p from cut),
t as materialized (
  select r, doc_id, n, case when known and h % 10 = 0 and n > 0
      then list_concat(w[:a], list_transform(range(a, n), lambda i: w[a + (i - a) % p + 1])) else w end as w
  from turned),
x as materialized (select r, n, i, w[i + 1] as x from t, unnest(range(n)) k(i)),
pairs as (
  select a.r, b.i - a.i as q, a.i,
         a.i - row_number() over (partition by a.r, b.i - a.i order by a.i) as island
  from x a join x b on a.r = b.r and a.x = b.x and b.i > a.i and 4 * (b.i - a.i) <= a.n),
stretches as materialized (
  select r, q, min(i) as s, count(*) + q as len from pairs group by r, q, island having count(*) + q >= greatest(6, 4 * q)),
runs as materialized (
  select * from stretches a where not exists (
    select 1 from stretches b where b.r = a.r and b.q < a.q and a.q % b.q = 0 and b.s <= a.s and b.s + b.len >= a.s + a.len)),
best as (
  select r, s, len, q, row_number() over (partition by r order by len::double / q desc, s, q) as k from runs),
told as (select r, count(*) as n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as told from runs group by r),
gone as (select distinct r, unnest(range(s + q, s + len)) as i from runs),
kept as (
  select x.r, string_agg(x.x, ' ' order by x.i) as kept from x left join gone using (r, i) where gone.i is null group by x.r)
select doc_id, cast(n as bigint) as n_words, coalesce(n_runs, 0) as n_runs, best.s as start, best.len as length,
       best.q as period, 1000 * best.len // best.q as exponent_milli, sha256(coalesce(told, '')) as runs_sha256,
       sha256(coalesce(kept, '')) as collapsed_sha256
from t left join told using (r) left join kept using (r) left join best on best.r = t.r and best.k = 1"""
