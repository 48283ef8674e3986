"""SQL twins of grown trees: the same cells, draws and cuts, written level by level.

Every statement below is a list of common tables. A search grows each candidate on its own, so the twins also check
that sharing a growth between depths and split sizes changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from itertools import product

from catalog import inputs as i
from catalog.cleaning import kfold_sql
from catalog.exploring import k_best_sql, mi_sql
from profilespark.operators.growth import EXACT_DRAWS, MAX_DEPTH, features_tried, poisson_table

SEED = 42


def _impurity(a: str, b: str) -> str:
    p, q = f"(({a})/(({a})+({b})))", f"(({b})/(({a})+({b})))"
    bits = lambda r: f"(case when {r}>0 then -{r}*log2({r}) else 0 end)"
    return f"(case when criterion='entropy' then {bits(p)}+{bits(q)} else 1-pow({p},2)-pow({q},2) end)"


def growth_sql(features: Sequence[str], depth: int, draws: bool, prefix: str = "") -> str:
    """Common tables from ``rows_`` (grp, row_id, features, y, w, fold) and ``fits`` (fit, grp, split, criterion, min_leaf,
    min_split, depth, trees, bootstrap, tried) with ``allowed`` (fit, ord) to ``predicted`` (fit, key, p) and ``cell``.

    All names start with the prefix.
    """
    t = lambda name: prefix + name
    key = f"concat_ws('|', {', '.join(features)}, y, w)"
    u = lambda part: f"(('0x'||substr(md5('{SEED}/'||tree||'/'||key),{1 + 13 * part},13))::bigint::double/4503599627370496::double)"
    z = f"(sqrt(-2*ln(1-{u(0)}))*cos(2*pi()*{u(1)}))"
    drawn = f"""case when not bootstrap or n0=0 then n0 when n0<={EXACT_DRAWS} then len(list_filter(cdf, lambda c: c<={u(0)}))
       else greatest(round(n0+sqrt(n0)*{z}+({z}*{z}-1)/6),0)::bigint end""" if draws else "n0"
    tables = [f"{t('poisson')} as materialized (select * from (values " + ", ".join(
        f"({n}, [{', '.join(repr(c) for c in row)}]::double[])" for n, row in enumerate(poisson_table() if draws else [[1.0]])) + ") p(n0, cdf))"]
    values = " union ".join(f"select {key} key, {o} ord, cast({f} as double) value from {t('rows_')}" for o, f in enumerate(features))
    tables += [
        f"{t('vals')} as materialized ({values})",
        f"""{t('cell')} as materialized (select fit, {key} key, y, w, count(*) filter (fold<>0 and fold<>split) n0, count(*) filter (fold=split) held
          from {t('rows_')} join {t('fits')} using (grp) group by all)""",
        f"""{t('drawn')} as materialized (select fit, tree, key, y, w, {drawn} n
          from (select *, unnest(range(1, trees+1)) tree from {t('cell')} join {t('fits')} using (fit)) left join {t('poisson')} using (n0))""",
        f"{t('node0')} as materialized (select fit, tree, key, 1::bigint node from {t('drawn')})",
    ]
    mass = "sum(case when y=-1 then n*w else 0 end) a, sum(case when y<>-1 then n*w else 0 end) b, sum(n) n"
    for level in range(depth + 1):
        gain = (f"{_impurity('ta', 'tb')}-(la+lb)/(ta+tb)*{_impurity('la', 'lb')}-(ta+tb-la-lb)/(ta+tb)*{_impurity('(ta-la)', '(tb-lb)')}")
        tables += [
            f"""{t(f'sums{level}')} as materialized (select fit, tree, node, {mass} from {t(f'node{level}')} join {t('drawn')} using (fit, tree, key)
              where n>0 group by fit, tree, node)""",
            f"""{t(f'line{level}')} as materialized (select *, lead(value) over o nxt, sum(a) over (o rows unbounded preceding) la, sum(b) over (o rows unbounded preceding) lb,
                sum(n) over (o rows unbounded preceding) ln, sum(a) over f ta, sum(b) over f tb, sum(n) over f tn
              from (select fit, tree, node, ord, value, {mass} from {t(f'node{level}')} join {t('drawn')} using (fit, tree, key) join {t('allowed')} using (fit)
                    join {t('vals')} using (key, ord) where n>0 group by fit, tree, node, ord, value)
              window f as (partition by fit, tree, node, ord), o as (partition by fit, tree, node, ord order by value))""",
            f"""{t(f'gain{level}')} as materialized (select l.*, tried, (value+nxt)/2 cut,
                case when ln>=min_leaf and tn-ln>=min_leaf and la+lb>0 and ta+tb-la-lb>0 then round({gain},12) end gain
              from {t(f'line{level}')} l join {t('fits')} using (fit) where nxt is not null and depth>{level} and tn>=min_split)""",
            f"""{t(f'best{level}')} as materialized (select * from (select *, row_number() over (partition by fit, tree, node order by gain desc, ord, cut) place
                from {t(f'gain{level}')} join (select fit, tree, node, ord, row_number() over (partition by fit, tree, node order by md5('{SEED}/'||tree||'/'||node||'/'||ord)) turn
                  from (select distinct fit, tree, node, ord from {t(f'gain{level}')})) using (fit, tree, node, ord)
                where turn<=tried and gain>1e-12) where place=1)""",
            f"""{t(f'leaf{level}')} as materialized (select n.fit, n.tree, n.key, s.a/(s.a+s.b) value from {t(f'node{level}')} n join {t(f'sums{level}')} s using (fit, tree, node)
              left join {t(f'best{level}')} b using (fit, tree, node) where b.node is null)""",
            f"""{t(f'node{level + 1}')} as materialized (select n.fit, n.tree, n.key, 2*n.node+(case when v.value>b.cut then 1 else 0 end) node
              from {t(f'node{level}')} n join {t(f'best{level}')} b using (fit, tree, node) join {t('vals')} v on v.key=n.key and v.ord=b.ord)""",
        ]
    leaves = " union all ".join(f"select * from {t(f'leaf{level}')}" for level in range(depth + 1))
    tables.append(f"{t('predicted')} as materialized (select fit, key, round(avg(value),12) p from ({leaves}) group by fit, key)")
    return ",\n".join(tables)


def key_of(features: Sequence[str]) -> str:
    return f"concat_ws('|', {', '.join(features)}, y, w)"


def _rows(source: str, weight: str, fold: str, features: Sequence[str], grp: str = "0") -> str:
    return f"select {grp} grp, row_id, {', '.join(features)}, Result y, cast({weight} as double) w, cast({fold} as int) fold from {source}"


def _fit_row(params: Mapping[str, object], features: Sequence[str]) -> str:
    """criterion, min_leaf, min_split, depth, trees, bootstrap, tried of a parameter record (names without prefix)."""
    k = len(features) if str(params.get("k", "all")) == "all" else int(params["k"])
    forest = "n_estimators" in params
    tried = features_tried(params.get("max_features", "sqrt"), k) if forest else None
    depth = params.get("max_depth")
    return (f"'{params.get('criterion', 'gini')}', {params.get('min_samples_leaf', 1)}, {params.get('min_samples_split', 2)}, {MAX_DEPTH if depth is None else depth}, "
            f"{params.get('n_estimators', 1)}, {str(bool(forest and params.get('bootstrap', True))).lower()}, {k if tried is None else tried}")


FIT_COLUMNS = "criterion, min_leaf, min_split, depth, trees, bootstrap, tried"


def short(parameters: Mapping[str, object]) -> dict[str, object]:
    """A parameter record under names without prefix."""
    return {n.split("__")[1]: v for n, v in parameters.items()}


def fit_sql(source: str, parameters: Mapping[str, object], weight: str = "1", train: str = "true", features: Sequence[str] = i.DOC_FEATURES,
            levels: int | None = None) -> str:
    """``row_id, y_true, y_pred, p`` of all rows by a model grown on those where ``train`` holds."""
    params = short(parameters)
    k = len(features) if str(params.get("k", "all")) == "all" else int(params["k"])
    depth = params.get("max_depth") or levels
    chosen = k_best_sql(mi_sql(f"(select * from {source} where {train})", features), features)
    orders = ", ".join(f"('{f}', {o})" for o, f in enumerate(features))
    return f"""
with rows_ as materialized ({_rows(source, weight, f"case when {train} then 1 else 0 end", features)}),
fits as materialized (select 0 fit, 0 grp, 0 split, * from (values ({_fit_row(params, features)})) v({FIT_COLUMNS})),
allowed as materialized (select 0 fit, ord from ({chosen}) join (values {orders}) o(feature, ord) using (feature) where place<={k}),
{growth_sql(features, int(depth), bool(params.get('bootstrap', True)) and 'n_estimators' in params)}
select row_id, y y_true, cast(case when p>=0.5 then -1 else 1 end as int) y_pred, p from rows_ join predicted on predicted.key={key_of(features)}"""


def grid(space: Mapping[str, Sequence[object]]) -> list[dict[str, object]]:
    """Every combination, numbered from 1."""
    names = sorted(space)
    return [{"candidate_id": n, **dict(zip(names, values))} for n, values in enumerate(product(*(space[n] for n in names)), 1)]


def draw(space: Mapping[str, Sequence[object]], n: int, seed: int) -> list[dict[str, object]]:
    order = sorted(grid(space), key=lambda c: hashlib.md5(f"{seed}:{c['candidate_id']}".encode()).hexdigest())[:n]
    return [{**c, "candidate_id": place} for place, c in enumerate(order, 1)]


def candidate_rows(candidates: Mapping[int, Sequence[Mapping[str, object]]], features: Sequence[str]) -> str:
    """Every group's candidates as values: grp, candidate_id, k, the number of features taken, and the columns of a fit."""
    out = []
    for group, records in candidates.items():
        for c in records:
            params = short({n: v for n, v in c.items() if n != "candidate_id"})
            take = len(features) if str(params["k"]) == "all" else int(params["k"])
            depth = params.get("max_depth")
            out.append(f"({group}, {c['candidate_id']}, '{params['k']}', {take}, {'null' if depth is None else depth}, {_fit_row(params, features)})")
    return f"(values {', '.join(out)}) c(grp, candidate_id, feature_selection__k, take, classifier__max_depth, {FIT_COLUMNS})"


def search_sql(prefix: str, candidates: Mapping[int, Sequence[Mapping[str, object]]], n_splits: int, depth: int, draws: bool, features: Sequence[str] = i.DOC_FEATURES,
               rows: str = "rows_") -> str:
    """Common tables from a table of rows to ``{prefix}scores`` (grp, candidate_id, split, score) of every candidate."""
    orders = ", ".join(f"('{f}', {o})" for o, f in enumerate(features))
    information = mi_sql("(select r.*, y Result, grp*100+s split_of from {rows} r join (select unnest(range(1, {n}+1)) s) on fold<>0 and fold<>s)".format(n=n_splits, rows=rows), features, "split_of")
    return f"""
{prefix}rows_ as materialized (select * from {rows}),
{prefix}candidates as materialized (select * from {candidate_rows(candidates, features)}),
{prefix}chosen as materialized (select split_of, ord, place from ({k_best_sql(information, features, 'split_of')}) join (values {orders}) o(feature, ord) using (feature)),
{prefix}fits as materialized (select cast(row_number() over (order by grp, candidate_id, split) as int) fit, * from {prefix}candidates join (select cast(unnest(range(1, {n_splits}+1)) as int) split) on true),
{prefix}allowed as materialized (select fit, ord from {prefix}fits join {prefix}chosen on split_of=grp*100+split where place<=take),
{growth_sql(features, depth, draws, prefix)},
{prefix}scores as materialized (select grp, candidate_id, split, sum(case when (p>=0.5)=(y=-1) then held*w else 0 end)/sum(held*w) score
  from {prefix}cell join {prefix}predicted using (fit, key) join {prefix}fits using (fit) where held>0 group by grp, candidate_id, split)"""


def chosen_sql(prefix: str) -> str:
    """Common tables from the scores of five splits to ``{prefix}picked`` with the one-standard-error choice flagged."""
    return f"""
{prefix}results as materialized ({i.results_sql(prefix + 'scores', 'grp')}),
{prefix}picked as materialized ({i.one_se_sql(prefix + 'results', prefix + 'candidates', 'grp').replace('using (candidate_id)', 'using (grp, candidate_id)')})"""


def refit_sql(prefix: str, picked: str, depth: int, draws: bool, features: Sequence[str] = i.DOC_FEATURES) -> str:
    """Common tables to ``{prefix}predicted``: each group's choice refitted on all of its folds; ``fit`` is the group."""
    orders = ", ".join(f"('{f}', {o})" for o, f in enumerate(features))
    information = mi_sql("(select *, y Result from rows_ where fold<>0)", features, "grp")
    return f"""
{prefix}rows_ as materialized (select * from rows_),
{prefix}fits as materialized (select grp fit, grp, 0 split, take, {FIT_COLUMNS} from {picked} where selected_by_one_se),
{prefix}allowed as materialized (select fit, ord from ({k_best_sql(information, features, 'grp')}) join (values {orders}) o(feature, ord) using (feature)
  join {prefix}fits using (grp) where place<=take),
{growth_sql(features, depth, draws, prefix)}"""


def nested_rows(source: str, weight: str, n_outer: int, n_inner: int, features: Sequence[str] = i.DOC_FEATURES) -> str:
    """Common tables ``outer_rows`` and ``rows_``: every row once per outer fold, with its inner fold or 0 where held out."""
    copies = f"(select * exclude (outer_fold), f.i outer_fold from outer_rows join (select unnest(range(1,{n_outer + 1})) i) f on f.i<>outer_fold)"
    inner = kfold_sql(copies, n_inner, f"{SEED}+outer_fold", "inner_fold", "outer_fold")
    return f"""
outer_rows as materialized ({kfold_sql(source, n_outer, str(SEED), 'outer_fold')}),
rows_ as materialized ({_rows(f'({inner})', weight, 'inner_fold', features, 'cast(outer_fold as int)')}
  union all {_rows('outer_rows', weight, '0', features, 'cast(outer_fold as int)')})"""
