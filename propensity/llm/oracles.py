"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

#: Sources in code point order weigh 3, 1, 2, repeating; the k sources that fill up
#: first stop at twice their size, the rest share what is left by weight.
MIXING = r"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
                  md5(concat(coalesce(cast(doc_id as varchar), ''), ':mix:', coalesce(text, ''))) as h
           from documents),
s as (select source, cast(sum(size) as bigint) as n from d group by source),
w as (select *, list_extract([3.0::double, 1.0::double, 2.0::double], cast((row_number() over
             (order by source is null, source collate "binary") - 1) % 3 + 1 as int)) as w from s),
o as (select *, 2 * n / w as r, row_number() over (order by 2 * n / w, source) as k from w),
c as (select *, coalesce(sum(2 * n) over (order by k rows between unbounded preceding and 1 preceding), 0) as f,
             sum(w) over (order by k rows between current row and unbounded following) as free
      from o),
l as (select min_by((1.5 * (select sum(n) from s) - f) / free, k) as level
      from c where (1.5 * (select sum(n) from s) - f) / free <= r),
t as (select source, n, cast(least(cast(2 * n as double), w * coalesce((select level from l), 1e300)) as double) as target
      from w),
b as (select *, cast(floor(target) as bigint) as budget from t),
p as (select d.doc_id, d.source, d.size, b.n, b.target, b.budget,
             coalesce(sum(d.size) over (partition by d.source order by h, d.doc_id
                      rows between unbounded preceding and 1 preceding), 0) as before
      from d join b on d.source is not distinct from b.source)
select doc_id, cast(size as bigint) as size, n as source_size, target,
       cast(case when n = 0 then 0 else (budget // n) * size
            + greatest(0, least(size, budget - (budget // n) * n - before)) end as bigint) as taken
from p
"""

#: Every anchor against every row.
HARD_NEGATIVES = """
with v as (select vec_id, cast(if(vec_id % 7 = 0, (cast(label as bigint) + 1) % 10, label) as bigint) as label,
                  [floor(256 * cast(x as double)) for x in embedding] as x
           from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
             cast(list_dot_product(a.x, b.x) as bigint) as score
      from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.x) = len(b.x)),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) as int) as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from p join s n on n.anchor_id = p.anchor_id and not n.same
     and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify rank <= 3
"""
