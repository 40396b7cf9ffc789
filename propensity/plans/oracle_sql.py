"""DuckDB SQL text that independently computes what each registered query returns.

The driver registers the input tables as views; these statements read them
directly, so they check the Spark plans end to end.
"""

from __future__ import annotations

import math


def u(key: str, salt: str, digits: int = 8) -> str:
    h = f"substr(md5(concat(cast({key} as varchar), ':{salt}')),1,{digits})"
    return f"((cast(('0x'||{h}) as ubigint)::double+0.5)/{float(16 ** digits)!r})"


def hash_order(key: str, salt: str) -> str:
    return f"md5(concat(cast({key} as varchar), ':{salt}'))"


def exact_sum(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(38,6))) as double)"


DAYS = "date_diff('day', cast(o_orderdate as date), DATE '2001-08-02')"

RAW = f"""
select *, case when {u('id', 'response')} < case when Previously_Insured=1 then 0.01
                                        when Vehicle_Damage='Yes' then 0.30 else 0.06 end
               then 1 else 0 end as Response
from (select o_orderkey as id,
             case when c_custkey % 2 = 0 then 'Male' else 'Female' end as Gender,
             cast(20 + c_custkey % 66 as int) as Age,
             case when o_orderkey % 500 = 0 then 0 else 1 end as Driving_License,
             cast(c_nationkey as double) as Region_Code,
             case when o_orderstatus='F' or c_mktsegment='AUTOMOBILE' then 1 else 0 end as Previously_Insured,
             case when o_orderpriority in ('1-URGENT','2-HIGH') then '< 1 Year'
                  when o_orderpriority='5-LOW' then '> 2 Years' else '1-2 Year' end as Vehicle_Age,
             case when cast(floor(o_totalprice) as bigint) % 2 = 1 then 'Yes' else 'No' end as Vehicle_Damage,
             o_totalprice as Annual_Premium,
             cast(o_custkey % 160 as double) as Policy_Sales_Channel,
             cast({DAYS} as int) as Vintage
      from orders join customer on o_custkey = c_custkey) b
"""

_TWO_PI = repr(2 * math.pi)


def prepared_sql(variant: str = "python") -> str:
    """G1-G3 over the raw prospects.  ``python``: lognormal draw, low amounts
    zeroed, double premium.  ``r``: normal draw, amounts floored at the
    cutoff, premium truncated to int."""
    draw = f"1.75*sqrt(-2*ln({u('id', 'c1')}))*cos({_TWO_PI}*{u('id', 'c2')})"
    if variant == "python":
        draw, kept, premium = f"exp({draw})", "(case when s<10 then 0.0 else s end)", \
            "Annual_Premium/(mp/2080.0)"
    else:
        kept, premium = "greatest(s, 10.0)", "cast(trunc(Annual_Premium/(mp/2080.0)) as int)"
    return f"""
with p as ({RAW}),
a as (select *, {draw} as ln0 from p),
b as (select *, ln0*(120000.0/(select max(ln0) from a)) as s,
             (select {exact_sum('Annual_Premium')}/count(Annual_Premium) from a) as mp from a),
d as (select *, {kept}*(0.8+0.4*{u('id', 'c3')})
                *(case when Response=1 then 1.8+1.2*{u('id', 'c4')} else 1.0 end) as amt from b),
e as (select *, cast(floor(round(amt,6)) as int) as Claims_Amount from d),
f as (select *, case when Claims_Amount>0 then (Claims_Amount/40.0)*({1.0 / 3!r}+({3 - 1.0 / 3!r})*{u('id', 'c5')}) end as r from e),
g as (select *, (select min(r) from f) as mn from f)
select id, Gender, Age, Driving_License, Region_Code, Previously_Insured, Vehicle_Age, Vehicle_Damage,
       {premium} as Annual_Premium, Policy_Sales_Channel, Vintage, Response, Claims_Amount,
       case when Claims_Amount>0 then cast(floor(round(greatest(r-mn,1.0),6)) as int) else 0 end as Claims_Num
from g
"""


PREPARED = prepared_sql("python")


def with_prepared(body: str) -> str:
    """Wrap a query over relation ``t`` (the prepared table)."""
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with t as ({PREPARED}),\n{body[5:]}"
    return f"with t as ({PREPARED})\n{body}"


REGION_AGG = f"""
select Region_Code as region_code,
       count(*) as region_prospects,
       round(sum(Annual_Premium), 4) as total_annual_premium,
       cast(sum(Claims_Amount) as bigint) as total_claims_amount,
       cast(sum(Claims_Num) as bigint) as total_claims_count
from t group by Region_Code
"""

BASE_COLS = ("id, Gender, Age, Driving_License, Region_Code, Previously_Insured, Vehicle_Age, "
             "Vehicle_Damage, Annual_Premium, Policy_Sales_Channel, Vintage, Response, "
             "Claims_Amount, Claims_Num")

PREMIUM_BY_AGE = "select Annual_Premium as annual_premium, Age as age from t where Annual_Premium > 500"

REGIONS_RANKED = f"select region_code, region_prospects from ({REGION_AGG}) order by region_prospects, region_code"

REGION_BUBBLE = f"""
select region_code, region_prospects, total_annual_premium, total_claims_count,
       round(case when total_claims_count > 0 then log10(cast(total_claims_count as double)) end, 9) as log10_claims_count
from ({REGION_AGG})
"""


def describe(cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"cast({c} as double)"
        parts.append(
            f"select '{c}' as feature, count({x}) as count, "
            f"round(avg({x}), 6) as mean, round(stddev_samp({x}), 6) as stddev, "
            f"min({x}) as min, max({x}) as max from t")
    return "\nunion all\n".join(parts)


def long_form(cols: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{c}' as name, cast({c} as varchar) as value from t" for c in cols)


def category_share(cols: list[str], mode: str = "percent1") -> str:
    if mode == "percent1":
        where = "where value is not null"
        prc = "round(100.0 * cast(n as double) / cast(sum(n) over (partition by name) as double), 1)"
        label = "printf('%.1f%%', prc)"
    else:
        where = ""
        prc = "round(cast(n as double) / cast(sum(n) over (partition by name) as double), 2)"
        label = "printf('%.2f', prc)"
    return f"""
with l as ({long_form(cols)}),
c as (select name, value, count(*) as n from l {where} group by name, value),
p as (select name, value, n, {prc} as prc from c)
select name, value, n, prc, {label} as label from p
"""


def correlation(cols: list[str], digits: int = 2) -> str:
    aggs = []
    for c in cols:
        aggs += [f"min(cast({c} as double)) as {c}__lo", f"max(cast({c} as double)) as {c}__hi"]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    for i, (a, b) in enumerate(pairs):
        aggs.append(f"corr(cast({a} as double), cast({b} as double)) as p{i}")
    rows = []
    for i, (a, b) in enumerate(pairs):
        v = (f"round(case when {a}__lo = {a}__hi or {b}__lo = {b}__hi then null "
             f"else p{i} end, {digits})")
        rows.append(f"select '{a}' as col1, '{b}' as col2, {v} as value from w")
        if a != b:
            rows.append(f"select '{b}' as col1, '{a}' as col2, {v} as value from w")
    return f"with w as (select {', '.join(aggs)} from t)\n" + "\nunion all\n".join(rows)


def histogram(col: str, label: str = "Response", bins: int = 30) -> str:
    x = f"cast({col} as double)"
    return f"""
with r as (select min({x}) as lo, max({x}) as hi from t),
h as (select {label}, cast(case when hi = lo then 0
                         else least(floor(({x} - lo) * {float(bins)!r} / (hi - lo)), {bins - 1}) end as int) as bin,
             count(*) as n
      from t, r where {col} is not null group by all)
select {label}, bin, lo + bin * ((hi - lo) / {float(bins)!r}) as bin_lo,
       lo + (bin + 1) * ((hi - lo) / {float(bins)!r}) as bin_hi, n
from h, r
"""


def box(col: str, label: str = "Response") -> str:
    x = f"cast({col} as double)"
    return f"""
with b as (select {label}, {x} as x from t where {col} is not null),
q as (select {label}, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median,
             quantile_cont(x, 0.75) as q3 from b group by {label}),
f as (select *, q1 - 1.5 * (q3 - q1) as lf, q3 + 1.5 * (q3 - q1) as uf from q)
select b.{label}, count(*) as n, min(x) as min, any_value(q1) as q1, any_value(median) as median,
       any_value(q3) as q3, max(x) as max,
       min(case when x >= lf then x end) as whisker_low, max(case when x <= uf then x end) as whisker_high,
       count_if(x < lf or x > uf) as outliers
from b join f on b.{label} is not distinct from f.{label} group by b.{label}
"""


ENCODE_SELECT = """
case Gender when 'Male' then 0 when 'Female' then 1 else error('unseen Gender') end as x_Gender,
case Vehicle_Age when '< 1 Year' then 0 when '1-2 Year' then 1 when '> 2 Years' then 2
     else error('unseen Vehicle_Age') end as x_Vehicle_Age,
case Vehicle_Damage when 'No' then 0 when 'Yes' then 1 else error('unseen Vehicle_Damage') end as x_Vehicle_Damage
"""

ENCODED = f"select *, {ENCODE_SELECT} from t"


def factor_codes(cols: list[str]) -> str:
    sel, joins = [], []
    for i, c in enumerate(cols):
        joins.append(f"left join (select v, cast(row_number() over (order by v) as int) as code "
                     f"from (select distinct cast({c} as varchar) as v from t where {c} is not null)) f{i} "
                     f"on cast(t.{c} as varchar) = f{i}.v")
        sel.append(f"f{i}.code as {c}")
    keep = [c.strip() for c in BASE_COLS.split(",") if c.strip() not in cols]
    return f"select {', '.join('t.' + k for k in keep)}, {', '.join(sel)} from t " + " ".join(joins)


def rebalanced_cte(salt: str = "boot") -> str:
    """CTE ``rb``: bootstrap of each class to count(Response = 0) rows."""
    return f"""
i as (select *, row_number() over (partition by Response order by id) - 1 as _k
      from t where Response is not null),
m as (select Response, count(*) as _m from i group by Response),
nn as (select cast(count_if(Response = 0) as bigint) as _n from i),
d as (select Response, _m, unnest(range(0, (select _n from nn))) as _i from m),
c as (select Response, cast(floor({u("concat(Response, '/', _i)", salt, 13)} * _m) as bigint) as _k,
             count(*) as _c from d group by all),
rb as (select {', '.join('i.' + c.strip() for c in BASE_COLS.split(','))}, unnest(range(1, c._c + 1)) as copy
       from i join c on i.Response = c.Response and i._k = c._k)
"""


ENCODED_IN_PLACE = f"""
select id, x_Gender as Gender, Age, Driving_License, Region_Code, Previously_Insured,
       x_Vehicle_Age as Vehicle_Age, x_Vehicle_Damage as Vehicle_Damage, Annual_Premium,
       Policy_Sales_Channel, Vintage, Response, Claims_Amount, Claims_Num
from (select *, {ENCODE_SELECT} from t)
"""

PACKED = "select Response, Age as f_Age, Previously_Insured as f_Previously_Insured, " \
    "Policy_Sales_Channel as f_Policy_Sales_Channel, Claims_Amount as f_Claims_Amount, " \
    "Claims_Num as f_Claims_Num from t"

REBALANCED_MINORITY = f"with t as ({PREPARED}),{rebalanced_cte()}select * from rb where Response <> 0 " \
    f"union all select {BASE_COLS}, cast(1 as bigint) as copy from t where Response = 0"

REBALANCED = f"with t as ({PREPARED}),{rebalanced_cte()}select * from rb"

POISSON = f"""
with t as ({PREPARED}),
b as (select * from t where Response is not null),
m as (select Response, count(*) as _m from b group by Response),
nn as (select cast(count_if(Response = 0) as bigint) as _n from b),
l as (select b.*, cast((select _n from nn) as double) / cast(m._m as double) as _lam,
             {u('id', 'pois', 13)} as _u from b join m on b.Response = m.Response),
j as (select id, _lam, _u,
             unnest(range(1, cast(ceil(_lam + 12.0 * sqrt(_lam) + 12.0) as bigint) + 1)) as j from l),
s as (select id, _lam, _u, j,
             exp(-_lam + sum(ln(_lam) - ln(cast(j as double))) over
                 (partition by id order by j rows between unbounded preceding and current row)) as p from j),
s2 as (select id, _lam, _u, exp(-_lam) + sum(p) over
                 (partition by id order by j rows between unbounded preceding and current row) as cdf from s),
cnt as (select id, (case when exp(-any_value(_lam)) < any_value(_u) then 1 else 0 end)
                   + cast(count_if(cdf < _u) as bigint) as _c from s2 group by id)
select {', '.join('l.' + c.strip() for c in BASE_COLS.split(','))}, unnest(range(1, cnt._c + 1)) as copy
from l join cnt on l.id = cnt.id where cnt._c >= 1
"""


def _split_case(key: str, test: float = 0.2) -> str:
    return f"case when {u(key, 'split')} < {1.0 - test!r} then 'train' else 'test' end"


SAMPLE_N = f"""
with t as ({PREPARED}),{rebalanced_cte()}
select {BASE_COLS}, copy from (
  select *, {hash_order("concat_ws('/', id, copy)", 'sample')} as _h from rb
) order by _h, id, copy limit 10000
"""

SPLIT_SIZES = f"""
with t as ({PREPARED}),{rebalanced_cte()}
select split, count(*) as n from (select {_split_case("concat_ws('/', id, copy)")} as split from rb)
group by split
"""

INFERENCE_DATA = f"""
with t as ({PREPARED}),{rebalanced_cte()}
select *, {ENCODE_SELECT}, {_split_case("concat_ws('/', id, copy)")} as split from rb
"""

STRATIFIED = f"""
with t as ({PREPARED})
select t.*, case when row_number() over (partition by Response order by {hash_order('id', 'split')}, id) - 1
                      < ceil(0.8 * count(*) over (partition by Response)) then 'train' else 'test' end as split
from t
"""


def _train_split_cte() -> str:
    split = _split_case("concat_ws('/', id, copy)")
    return (f"with t as ({PREPARED}),{rebalanced_cte()}, "
            f"s as (select *, {split} as split from rb)")


def minmax_scaled(cols: list[str]) -> str:
    stats = ", ".join(f"min(cast({c} as double)) as {c}__lo, max(cast({c} as double)) as {c}__hi" for c in cols)
    outs = ", ".join(f"case when {c}__hi = {c}__lo then 0.0 else (cast({c} as double) - {c}__lo) / "
                     f"({c}__hi - {c}__lo) end as {c}_mm" for c in cols)
    return (f"{_train_split_cte()}, st as (select {stats} from s where split = 'train')\n"
            f"select id, copy, split, {outs} from s, st")


def sd_scaled(cols: list[str]) -> str:
    stats = ", ".join(f"stddev_samp(cast({c} as double)) as {c}__sd" for c in cols)
    outs = ", ".join(f"round(case when {c}__sd = 0 then 0.0 else cast({c} as double) / {c}__sd end, 9) "
                     f"as {c}_sd" for c in cols)
    return (f"{_train_split_cte()}, st as (select {stats} from s where split = 'train')\n"
            f"select id, copy, split, {outs} from s, st")


RULE_PREDICTIONS = {
    "damage_rule": "cast(Vehicle_Damage = 'Yes' and Previously_Insured = 0 as int)",
    "claims_rule": "cast(Claims_Amount > 200 as int)",
    "never": "0",
}


def _rule_ctes() -> str:
    scored = "\nunion all\n".join(f"select '{k}' as algorithm, split, Response, {v} as prediction from s"
                                  for k, v in RULE_PREDICTIONS.items())

    def counts(pos: int) -> str:
        y, p = f"Response = {pos}", f"prediction = {pos}"
        return (f"select algorithm, split, {pos} as positive, count_if({y} and {p}) as tp, "
                f"count_if(not {y} and {p}) as fp, count_if({y} and not {p}) as fn, "
                f"count_if(not {y} and not {p}) as tn from sc group by algorithm, split")
    return (f"{_train_split_cte()}, sc as ({scored}), rc as ({counts(1)} union all {counts(0)}), "
            "rf as (select *, case when 2 * tp + fp + fn > 0 then cast(2.0 as double) * tp "
            "/ cast(2 * tp + fp + fn as double) else 0.0 end as f1 from rc)\n")


def rule_f1() -> str:
    return _rule_ctes() + ("select algorithm, split, cast(positive as int) as positive, cast(tp as bigint) as tp, "
                           "cast(fp as bigint) as fp, cast(fn as bigint) as fn, cast(tn as bigint) as tn, "
                           "cast(f1 as double) as f1 from rf")


def rule_runs() -> str:
    return _rule_ctes() + ("select algorithm as run_id, algorithm, "
                           "max(case when split = 'train' then f1 end) as f1_train, "
                           "max(case when split = 'test' then f1 end) as f1_test from rf where positive = 1 "
                           "group by algorithm having max(case when split = 'test' then f1 end) > 0.25 "
                           "order by f1_test desc, run_id")


def correlation_factors(numeric: list[str], text: list[str]) -> str:
    return with_prepared(f"with k as ({factor_codes(text)})\n" + correlation(numeric + text)
                         .replace("from t)", "from k)", 1).replace("with w as", ", w as", 1))


def sample_charts(cols: list[str], kind: str) -> str:
    body = []
    for c in cols:
        chart = histogram(c) if kind == "histogram" else box(c)
        body.append(f"select *, '{c}' as feature from ({chart})")
    sample = SAMPLE_N.strip()
    return f"with t as ({sample})\n" + "\nunion all\n".join(body)


# --- learners' steps and fixed models ---------------------------------------------

#: (alpha, lambda) of the boosted stumps.
STUMP_PENALTIES = [(0.0, 1.0), (0.1, 0.1), (5.0, 20.0)]


def boosted_stump(features: list[str], penalties: list, bins: int, eta: float = 0.1) -> str:
    """Best first split from margin 0 (gradient 0.5 - y, Hessian 0.25), cut points at
    ``bins`` exact quantiles."""
    long = " union all ".join(f"select '{f}' as feature, {i} as pos, cast({f} as double) as x, Response as y from t"
                              for i, f in enumerate(features))
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - a, 0.0))"
    pens = ", ".join(f"({a!r}::double, {lam!r}::double)" for a, lam in penalties)
    return with_prepared(f"""with x as ({long}),
r as (select feature, x, row_number() over (partition by feature order by x) - 1 as r,
             count(*) over (partition by feature) as m from x),
q as (select distinct feature, x as cut from r join (select unnest(range(0, {bins + 1})) as i) k
      on r.r = cast(floor(cast(k.i as double) * cast(m - 1 as double) / {float(bins)!r}) as bigint)),
c as (select * from q qualify cut < max(cut) over (partition by feature)),
s as (select x.feature, x.pos, c.cut, sum(case when x.x <= c.cut then 0.5 - x.y else 0.0 end)::double as gl,
             sum(case when x.x <= c.cut then 0.25 else 0.0 end)::double as hl, sum(0.5 - x.y)::double as g,
             sum(0.25)::double as h
      from x join c on x.feature = c.feature group by x.feature, x.pos, c.cut),
p as (select * from (values {pens}) v(a, lam)),
b as (select *, round({soft('gl')} ** 2 / (hl + lam) + {soft('(g - gl)')} ** 2 / (h - hl + lam)
                      - {soft('g')} ** 2 / (h + lam), 9) as gain from s, p where hl >= 1 and h - hl >= 1)
select a as reg_alpha, lam as reg_lambda, feature, cut as threshold, round(gain, 6) as gain,
       round(-{eta!r}::double * {soft('gl')} / (hl + lam), 9) as left_value,
       round(-{eta!r}::double * {soft('(g - gl)')} / (h - hl + lam), 9) as right_value
from b where gain > 1e-6 qualify row_number() over (partition by a, lam order by gain desc, pos, cut) = 1""")


def linear_booster_round(features: list[str], eta: float, alpha: float, lam: float) -> str:
    """Intercept, then the weights in order, from weights 0: every step moves the later gradients."""
    n = len(features)
    sds = ", ".join(f"stddev_samp(cast({f} as double)) as s{i}" for i, f in enumerate(features))
    zs = ", ".join(f"case when s{i} = 0 then 0.0 else cast({f} as double) / s{i} end as z{i}" for i, f in enumerate(features))
    firsts = [f"sum((0.5 - y) * z{i}) as g{i}, sum(0.25 * z{i}) as h{i}" for i in range(n)]
    seconds = [f"sum(0.25 * z{i} * z{j}) as h{i}_{j}" for i in range(n) for j in range(i, n)]
    ctes = [f"m as (select {sds} from t)", f"z as (select Response as y, {zs} from t, m)",
            f"k0 as (select count(*) as n, sum(0.5 - y) as g, sum(0.25)::double as h, {', '.join(firsts + seconds)} from z)",
            f"k as (select *, -{eta!r}::double * g / h as b from k0)"]
    prev = "k"
    for i in range(n):
        g = " + ".join([f"g{i}", f"b * h{i}", *[f"d{j} * h{j}_{i}" for j in range(i)]])
        hess = f"(h{i}_{i} + {lam!r}::double * n)"
        step = (f"case when -({g}) / {hess} >= 0 then greatest(-({g} + {alpha!r}::double * n) / {hess}, 0.0) "
                f"else least(-({g} - {alpha!r}::double * n) / {hess}, 0.0) end")
        ctes.append(f"k{i + 1}_ as (select *, {eta!r}::double * ({step}) as d{i} from {prev})")
        prev = f"k{i + 1}_"
    rows = " union all ".join([f"select 'intercept' as term, round(b, 9) as weight from {prev}",
                               *[f"select '{f}' as term, round(d{i}, 9) as weight from {prev}" for i, f in enumerate(features)]])
    return with_prepared("with " + ",\n".join(ctes) + f"\n{rows}")


def factor_stage(cols: list[str]) -> str:
    """Codes by alphabetical order of the levels of the train split."""
    split = _split_case("id")
    joins = " ".join(f"join (select v, cast(row_number() over (order by v) as int) as code from (select distinct {c} as v "
                     f"from t where {split} = 'train')) f{i} on t.{c} = f{i}.v" for i, c in enumerate(cols))
    return f"select t.id, {', '.join(f'f{i}.code as x_{c}' for i, c in enumerate(cols))} from t {joins}"


FIXED_FEATURES = ["Age", "Previously_Insured", "Claims_Amount", "Vintage"]
#: (tree, node, feature, threshold, left, right, value, gain)
FIXED_NODES = [
    (0, 0, 1, 0.5, 1, 4, 0.0, 1.0), (0, 1, 0, 40.5, 2, 3, 0.0, 1.0), (0, 2, -1, None, -1, -1, 0.35, 0.0),
    (0, 3, -1, None, -1, -1, 0.2, 0.0), (0, 4, -1, None, -1, -1, -0.8, 0.0),
    (1, 0, 2, 150.0, 1, 2, 0.0, 1.0), (1, 1, -1, None, -1, -1, -0.25, 0.0), (1, 2, -1, None, -1, -1, 0.45, 0.0),
    (2, 0, 3, 1000.0, 1, 4, 0.0, 1.0), (2, 1, 0, 30.0, 2, 3, 0.0, 1.0), (2, 2, -1, None, -1, -1, 0.1, 0.0),
    (2, 3, -1, None, -1, -1, -0.05, 0.0), (2, 4, -1, None, -1, -1, 0.15, 0.0),
]
FIXED_INTERCEPT, FIXED_WEIGHTS = -1.25, [0.03125, -2.0, 0.00390625, -0.00048828125]


def _walk(tree: int, node: int, leaf) -> str:
    _, _, f, th, left, right, value, _ = next(r for r in FIXED_NODES if r[:2] == (tree, node))
    if f < 0:
        return leaf(node, value)
    return (f"case when {FIXED_FEATURES[f]} <= {th!r} then {_walk(tree, left, leaf)} "
            f"else {_walk(tree, right, leaf)} end")


_TREES = sorted({r[0] for r in FIXED_NODES})
_MARGIN = " + ".join(f"({_walk(t, 0, lambda _, v: f'{v!r}::double')})" for t in _TREES)
ENSEMBLE_SCORES = f"""
select id, cast(margin > 0 as int) as prediction, round(1 / (1 + exp(-margin)), 9) as probability
from (select id, {_MARGIN} as margin from t)
"""
LINEAR_SCORES = f"""
select id, Response, cast({FIXED_INTERCEPT!r} + {' + '.join(f'{w!r}::double * {f}' for w, f in zip(FIXED_WEIGHTS, FIXED_FEATURES))} > 0
                          as int) as prediction from t
"""
_NODE_VALUES = ", ".join(f"({t}, {i}, {f}, {'null' if th is None else repr(th)}::double, {v!r}::double)"
                         for t, i, f, th, _, _, v, _ in FIXED_NODES)
ENSEMBLE_NODES = with_prepared(f"""with l as ({' union all '.join(
    f"select {t} as tree, {_walk(t, 0, lambda i, _: str(i))} as node from t" for t in _TREES)}),
c as (select tree, node, count(*) as n from l group by all)
select v.tree, v.node, v.feature, v.threshold, v.value, coalesce(c.n, 0) as n
from (values {_NODE_VALUES}) v(tree, node, feature, threshold, value)
left join c on v.tree = c.tree and v.node = c.node
""")


def split_first() -> str:
    train = _split_case("id")
    return (f"with t0 as ({PREPARED}), t as (select * from t0 where {train} = 'train'),{rebalanced_cte()}"
            "select id, copy, 'train' as split, Response from rb union all "
            f"select id, cast(1 as bigint), 'test', Response from t0 where {train} = 'test'")


def describe_all(cols: list[str], numeric: list[str]) -> str:
    rows = []
    for c in cols:
        x = f"cast({c} as double)" if c in numeric else "cast(null as double)"
        rows.append(f"select 'count' as summary, '{c}' as \"column\", cast(count({c}) as double) as number, "
                    "cast(null as varchar) as text from t")
        rows += [f"select '{name}', '{c}', round({fn}({x}), 6), null from t" for name, fn in
                 (("mean", "avg"), ("stddev", "stddev_samp"))]
        for name in ("min", "max"):
            rows.append(f"select '{name}', '{c}', {f'round({name}({x}), 6), null' if c in numeric else f'null, {name}({c})'} from t")
    return " union all ".join(rows)


SAVED_VIEW = """select Region_Code as region_code, count(*) as claimants, max(Claims_Amount) as largest
from t where Claims_Num > 0 group by Region_Code"""
