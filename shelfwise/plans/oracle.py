"""The registered queries in DuckDB SQL over the raw test tables."""

from __future__ import annotations

from shelfwise.operators.split import bounds
from shelfwise.plans.queries import (
    LOOKUP_ASIN,
    QUERY_VECTORS,
    QUERY_WORDS,
    SEED,
    TEST_SEED,
    TEST_SPLIT,
    VALID_SPLIT,
)

REVIEW = """
review as (
  select case when l_partkey % 10 = 0 then -1 - l_partkey else l_partkey end as asin,
    case when l_linenumber = 7 then null
         else cast(1 + cast(l_quantity as int) % 5 as double) end as overall
  from lineitem
)"""

PRODUCT = """
ids as (select max(p_partkey) + 1 as n from part),
product as (
  select p_partkey as asin,
    case when p_partkey % 13 = 0 then '' when p_partkey % 17 = 0 then null else p_name end as title,
    case when p_partkey % 7 = 0 then null when p_partkey % 11 = 0 then cast('NaN' as float)
         else cast(p_retailprice as float) end as price,
    case when p_partkey % 19 = 0 then null when p_partkey % 23 = 0 then []::varchar[][]
         when p_partkey % 29 = 0 then [['']]
         else [[p_type, p_brand], [p_brand]] end as categories,
    case when p_partkey % 5 = 0 then null when p_partkey % 31 = 0 then map([]::varchar[], []::int[])
         else map([p_type, p_brand], [p_size, 2 * p_size]) end as sales_rank,
    case when p_partkey % 9 = 0 then null when p_partkey % 41 = 0 then []::bigint[]
         else [p_partkey * 7 % n, p_partkey * 7 % n, p_partkey * 3 % (n * 5 // 4), p_partkey * 11 % n]
              [1:1 + p_partkey % 4] end as also_viewed
  from part, ids
)"""

RATED = f"""{REVIEW},{PRODUCT},
rating as (
  select asin, avg(overall) as mean_rating, count(overall) as count_rating from review group by asin
),
rated as (
  select p.asin, r.mean_rating as "meanRating", r.count_rating as "countRating"
  from product p left join rating r on p.asin = r.asin
)"""

FLAT = f"""{PRODUCT},
flat as (
  select asin, nullif(categories[1][1], '') as category,
    map_keys(sales_rank)[1] as "bestSalesCategory",
    map_values(sales_rank)[1] as "bestSalesRank"
  from product
)"""

def _neighbour(skip_nan: bool) -> str:
    return f"""{PRODUCT},
edge as (select asin, unnest(also_viewed) as viewed from product),
near as (
  select e.asin, avg(cast(p.price as double)) as mean_price
  from edge e join product p on e.viewed = p.asin
  where p.price is not null{' and not isnan(p.price)' if skip_nan else ''}
  group by e.asin
),
priced as (
  select p.asin,
    case when len(p.also_viewed) > 0 then cast(len(p.also_viewed) as int) end as "countAlsoViewed",
    n.mean_price as "meanPriceAlsoViewed"
  from product p left join near n on p.asin = n.asin
)"""

NEIGHBOUR, NEIGHBOUR_NAN = _neighbour(True), _neighbour(False)

IMPUTED = f"""{PRODUCT},
valid as (select price from product where price is not null and not isnan(price)),
fill as (
  select avg(cast(price as double)) as mean, cast(quantile_disc(price, 0.5) as double) as median from valid
),
imputed as (
  select asin,
    case when price is null or isnan(price) then mean else cast(price as double) end as "meanImputedPrice",
    case when price is null or isnan(price) then median else cast(price as double) end as "medianImputedPrice",
    case when title is null or title = '' then 'unknown' else title end as "unknownImputedTitle"
  from product, fill
)"""

VOCABULARY = """
token as (select unnest(string_split(lower(text), ' ')) as word from documents),
vocabulary as (select word, count(*) as uses from token group by word having count(*) >= 100)"""

CATEGORY = """
frequency as (select p_brand as category, count(*) as n from part group by p_brand),
label as (
  select category, n, row_number() over (order by n desc, category) - 1 as position from frequency
)"""


def _statistics(column: str) -> str:
    return (
        f'round(avg("{column}"), 6) as "mean_{column}", '
        f'round(var_samp("{column}"), 6) as "variance_{column}"'
    )


def _nulls(column: str) -> str:
    return f'count(*) filter (where "{column}" is null) as "numNulls_{column}"'


def _distinct(column: str) -> str:
    return f'count(distinct "{column}") as "countDistinct_{column}"'


def _below(seed: int, key: str, weights: list[float]) -> str:
    """Whether a row belongs to the first of two parts."""
    number = f"cast('0x' || substr(md5('{seed}:' || {key}), 1, 15) as ubigint)"
    return f"{number} < {bounds(weights, 'md5')[0]}"


TYPE_PARTS = f"""
sized as (
  select p_partkey, p_type, cast(p_size as double) as y, {_below(TEST_SEED, 'p_partkey', TEST_SPLIT)} as in_train
  from part
)"""

_TYPE_RMSE = "sqrt(avg((s.y - m.mean) * (s.y - m.mean)))"

DEPTH_BY_TYPE = f"""{TYPE_PARTS},
fitting as (select * from sized where in_train and {_below(SEED, 'p_partkey', VALID_SPLIT)}),
validation as (select * from sized where in_train and not {_below(SEED, 'p_partkey', VALID_SPLIT)}),
means as (select p_type, avg(y) as mean from fitting group by p_type),
valid as (select {_TYPE_RMSE} as rmse from validation s join means m using (p_type)),
test as (select {_TYPE_RMSE} as rmse from sized s join means m using (p_type) where not in_train)"""

_queries = ", ".join(str(q) for q in QUERY_VECTORS)

ORACLE: dict[str, str] = {
    "price_lookup": f"with {PRODUCT} select asin, title, price from product where asin = {LOOKUP_ASIN}",
    "price_mean": f"""with {PRODUCT}
        select count(*) as count_total,
          round(avg(cast(price as double)) filter (where not isnan(price)), 6) as mean_price
        from product""",
    "price_mean_nan": f"""with {PRODUCT},
        m as (select count(*) as count_total, avg(cast(price as double)) as mean_price from product)
        select count_total, isnan(mean_price) as "is_nan_mean_price",
          case when not isnan(mean_price) then round(mean_price, 6) end as mean_price
        from m""",
    "neighbour_price_nan": f"""with {NEIGHBOUR_NAN}
        select asin, "countAlsoViewed", coalesce(isnan("meanPriceAlsoViewed"), false) as "is_nan_meanPriceAlsoViewed",
          case when not isnan("meanPriceAlsoViewed") then round("meanPriceAlsoViewed", 6) end as "meanPriceAlsoViewed"
        from priced""",
    "neighbour_profile_nan": f"""with {NEIGHBOUR_NAN},
        whole as (select bool_or(isnan("meanPriceAlsoViewed")) as nan from priced)
        select count(*) as count_total, any_value(nan) as "is_nan_mean_meanPriceAlsoViewed",
          any_value(nan) as "is_nan_variance_meanPriceAlsoViewed",
          case when not any_value(nan) then round(avg("meanPriceAlsoViewed") filter (where not isnan("meanPriceAlsoViewed")), 6) end
            as "mean_meanPriceAlsoViewed",
          case when not any_value(nan) then round(var_samp("meanPriceAlsoViewed") filter (where not isnan("meanPriceAlsoViewed")), 6) end
            as "variance_meanPriceAlsoViewed",
          {_nulls('meanPriceAlsoViewed')}, {_statistics('countAlsoViewed')}, {_nulls('countAlsoViewed')}
        from priced, whole""",
    "record_saved": f"""with {RATED}
        select count(*) as count_total, {_statistics('meanRating')}, {_nulls('meanRating')},
          {_statistics('countRating')}, {_nulls('countRating')},
          cast(null as double) as "mean_never", cast(null as double) as "variance_never", count(*) as "numNulls_never", 10 as n_keys
        from rated""",
    "category_variances": f"""with recursive {CATEGORY},
        same as (select n, count(*) as m, row_number() over (order by n desc) as i from frequency group by n),
        whole as (select list({{'n': n, 'm': m}}) as counts, sum(n * m) as total from same),
        search as (
          select a.i, cast(b.n as double) as lo, cast(a.n as double) as hi, 0 as step from same a join same b on b.i = a.i + 1
          union all
          select i, case when below then lo else middle end, case when below then middle else hi end, step + 1
          from (select *, (lo + hi) / 2 as middle,
                  list_sum([x.m * x.n * x.n / (x.n - (lo + hi) / 2) for x in counts]) > total as below
                from search, whole where step < 55)
        ),
        found as (
          select i, 1 as kind, unnest(range(m - 1)) as copy, n / total as variance from same, whole
          union all
          select i, 2, 0, (lo + hi) / 2 / total from search, whole where step = 55
          union all
          select max(i), 2, 0, 0 from same
        )
        select cast(row_number() over (order by i, kind, copy) as int) as component, round(variance, 9) as variance from found""",
    "planted_neighbours": """
        with orders_of as (select o_orderkey, o_custkey, lower(substr(o_orderpriority, 1, 1)) as topic from orders),
        word as (
          select distinct topic, topic || '_' || ((o_orderkey * (i + 1) + o_custkey + i) % 6) as word
          from orders_of, (select unnest(range(0, 10)) as i)
        )
        select a.word as query, string_agg(b.word, ',' order by b.word) as neighbours
        from word a join word b on a.topic = b.topic and a.word <> b.word group by a.word""",
    "preview_whole": "select 5::bigint as n_rows, 6 as n_columns, 5::bigint as n_known",
    "title_embedding_counts": f"""with {VOCABULARY}
        select (select count(*) from documents) as count_total, (select count(*) from vocabulary) as size_vocabulary,
          {', '.join(f"""(select cast(least(10, count(*) - 1) as int) from vocabulary
            where '{word}' in (select word from vocabulary)) as word_{i}_length""" for i, word in enumerate(QUERY_WORDS))}""",
    "category_encoding_full": f"""with {CATEGORY},
        share as (select position, n / (select count(*) from part) as p from label)
        select (select count(*) from part) as count_total, round((select sum(p * p) from share), 6) as squared_mean,
          cast(position as int) as position, round(p, 6) as share
        from share""",
    "category_pca": f"""with {CATEGORY}
        select p_partkey as asin, cast((select count(*) from label) as int) as width, cast(1 as double) as squared_length from part""",
    "tree_baseline_by_type": f"""with {TYPE_PARTS},
        means as (select p_type, avg(y) as mean from sized where in_train group by p_type)
        select round({_TYPE_RMSE}, 6) as test_rmse
        from sized s join means m using (p_type) where not in_train""",
    "rating_rollup": f"""with {RATED}
        select asin, round("meanRating", 6) as "meanRating", "countRating" from rated""",
    "rating_profile": f"""with {RATED}
        select count(*) as count_total, {_statistics('meanRating')}, {_nulls('meanRating')},
          {_statistics('countRating')}, {_nulls('countRating')}
        from rated""",
    "category_flatten": f"with {FLAT} select * from flat",
    "category_profile": f"""with {FLAT}
        select count(*) as count_total, {_statistics('bestSalesRank')},
          {_nulls('category')}, {_distinct('category')},
          {_nulls('bestSalesCategory')}, {_distinct('bestSalesCategory')}
        from flat""",
    "neighbour_price": f"""with {NEIGHBOUR}
        select asin, "countAlsoViewed", round("meanPriceAlsoViewed", 6) as "meanPriceAlsoViewed"
        from priced""",
    "neighbour_profile": f"""with {NEIGHBOUR}
        select count(*) as count_total, {_statistics('meanPriceAlsoViewed')}, {_nulls('meanPriceAlsoViewed')},
          {_statistics('countAlsoViewed')}, {_nulls('countAlsoViewed')}
        from priced""",
    "impute_prices": f"""with {IMPUTED}
        select asin, round("meanImputedPrice", 6) as "meanImputedPrice",
          round("medianImputedPrice", 6) as "medianImputedPrice", "unknownImputedTitle"
        from imputed""",
    "impute_profile": f"""with {IMPUTED}
        select count(*) as count_total, {_statistics('meanImputedPrice')}, {_nulls('meanImputedPrice')},
          {_statistics('medianImputedPrice')}, {_nulls('medianImputedPrice')},
          count(*) filter (where "unknownImputedTitle" = 'unknown') as "numUnknowns_unknownImputedTitle"
        from imputed""",
    "tokens_vocabulary": f"with {VOCABULARY} select word, uses from vocabulary",
    "embedding_vocabulary": f"with {VOCABULARY} select word from vocabulary",
    "nearest_vectors": f"""
        with pair as (
          select q.vec_id as query, v.vec_id,
            list_cosine_similarity(cast(v.embedding as double[]), cast(q.embedding as double[])) as similarity
          from embeddings v join embeddings q on q.vec_id <> v.vec_id
          where q.vec_id in ({_queries})
        ),
        ranked as (
          select query, cast(row_number() over (partition by query order by similarity desc, vec_id) as int) as rank,
            vec_id, similarity
          from pair
        )
        select query, rank, vec_id, round(similarity, 6) as similarity from ranked where rank <= 10""",
    "category_index": f"""with {CATEGORY}
        select p_partkey as asin, category, cast(position as double) as "categoryIndex"
        from part join label on p_brand = category""",
    "onehot_mean": f"""with {CATEGORY}
        select cast(position as int) as position, round(n / (select count(*) from part), 6) as share
        from label""",
    "pca_energy": f"""with {CATEGORY},
        share as (select n, n / (select count(*) from part) as p, (select count(*) from part) as total from label)
        select count(*) as components, round(sum(p * p), 6) as squared_mean,
          round(sum(p * (1 - p) * total / (total - 1)), 6) as total_variance
        from share""",
    "hash_split": f"""
        select vec_id, case when {_below(SEED, 'vec_id', VALID_SPLIT)} then 0 else 1 end as split
        from embeddings""",
    "rmse_metric": f"""with {REVIEW},
        rated as (select asin, overall, avg(overall) over (partition by asin) as mean
                  from review where overall is not null)
        select round(sqrt(avg((overall - mean) * (overall - mean))), 6) as rmse from rated""",
    "tree_by_type": f"""with {TYPE_PARTS},
        means as (select p_type, avg(y) as mean from sized where in_train group by p_type)
        select round({_TYPE_RMSE}, 6) as test_rmse
        from sized s join means m using (p_type) where not in_train""",
    "tree_depth_zero": f"""
        with labelled as (
          select cast(label as double) as y, {_below(TEST_SEED, 'vec_id', TEST_SPLIT)} as in_train from embeddings
        ),
        means as (select avg(y) as mean from labelled where in_train)
        select round(sqrt(avg((y - mean) * (y - mean))), 6) as test_rmse
        from labelled, means where not in_train""",
    "depth_sweep_by_type": f"""with {DEPTH_BY_TYPE}
        select round(test.rmse, 6) as test_rmse,
          {', '.join(f'round(valid.rmse, 6) as valid_rmse_depth_{d}' for d in (5, 7, 9, 12))}
        from valid, test""",
}
