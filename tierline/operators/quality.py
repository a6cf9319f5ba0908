"""Data-quality checks Q1-Q15. Each returns the offending rows; an empty result is a pass.

Row-level predicates are also available as named rules (``bronze_rules``) so that all checks on one
table are counted in a single aggregate pass (``rule_counts``) instead of one scan per check.
Group checks (duplicates, fan-out) aggregate with map-side partial counts, so a hot key costs one
row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import codes
from tierline.functions.expressions import has_eight_digits, has_outer_spaces, map_code
from tierline.operators.gold import integrated_gender
from tierline.operators.absence import absent_rows, not_in
from tierline.operators.joins import BROADCAST_MAX_ROWS, fits_broadcast, lookup_join
from tierline.operators.silver import repaired_price, repaired_sales
from tierline.staging import Stats, measure_all, stage


def _any(preds: Sequence[Column]) -> Column:
    out = None
    for p in preds:
        out = p if out is None else out | p
    return out


# ---- Q1 / Q12 / Q14: key duplicates --------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: str | Sequence[str], include_null: bool = True,
                   count_name: str = "n_rows") -> DataFrame:
    """Q1: key values occurring more than once, or NULL (with ``include_null``), with counts."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    cond = F.col(count_name) > 1
    if include_null:
        cond = cond | _any([F.col(k).isNull() for k in keys])
    return counted.filter(cond)


def _fanout(rows: DataFrame, key: str, joins: Sequence[tuple[str, DataFrame, str]], name: str) -> DataFrame:
    """Values of ``key`` that appear more than once after left joins of ``rows`` with each (column, side, side
    column), with their counts, from multiplicities alone.

    A row appears once for every combination of its partners: the product of its key's counts on the
    sides (1 where there is none). Sides shrink to the keys that repeat, counted with a map-side combine,
    so the joined rows are never made and a side without repeated keys costs no join to speak of.
    """
    times, out = F.lit(1).cast("bigint"), rows.select(F.col(key).alias(name), *[F.col(c) for c, _, _ in joins])
    for i, (column, side, side_column) in enumerate(joins):
        repeated = stage(side.filter(F.col(side_column).isNotNull()).groupBy(F.col(side_column).alias(f"_tl_k{i}"))
                         .agg(F.count(F.lit(1)).alias(f"_tl_n{i}")).filter(F.col(f"_tl_n{i}") > 1), "fanout")
        out = lookup_join(out, repeated.df, [(column, f"_tl_k{i}")], stats=repeated.stats)
        times = times * F.coalesce(f"_tl_n{i}", F.lit(1))
    return out.groupBy(name).agg(F.sum(times).alias("n_rows")).filter(F.col("n_rows") > 1)


def customer_fanout(cust: DataFrame, erp_cust: DataFrame, erp_loc: DataFrame) -> DataFrame:
    """Q12: customers that appear more than once after the dimension's joins."""
    return _fanout(cust, "cst_id", [("cst_key", erp_cust.select("cid"), "cid"),
                                    ("cst_key", erp_loc.select("cid"), "cid")], "customer_id")


def product_fanout(prd: DataFrame, cat: DataFrame) -> DataFrame:
    """Q14: current products that appear more than once after the category join."""
    return _fanout(prd.filter(F.col("prd_end_dt").isNull()), "prd_key", [("cat_id", cat.select("id"), "id")], "product_number")


# ---- row predicates (Q2, Q3, Q5, Q6, Q7, Q9) -------------------------------------------------

def is_null(cols: Sequence[str]) -> Column:
    return _any([F.col(c).isNull() for c in cols])


def has_spaces(cols: Sequence[str], collation: str | None = None) -> Column:
    """Leading or trailing spaces. With a ``collation`` the value is compared with its trimmed form under
    it: ``codes.SOURCE_COLLATION`` does not see trailing spaces, as in the source system."""
    if collation is not None:
        return _any([F.collate(F.col(c), collation) != F.trim(c) for c in cols])
    return _any([has_outer_spaces(c) for c in cols])


def negative_or_null(c: str) -> Column:
    return (F.col(c) < 0) | F.col(c).isNull()


def out_of_order(pairs: Sequence[tuple[str, str]]) -> Column:
    """Any (earlier, later) pair with later < earlier."""
    return _any([F.col(later) < F.col(earlier) for earlier, later in pairs])


def invalid_int_date(c: str, lo: int = codes.INT_DATE_MIN, hi: int = codes.INT_DATE_MAX) -> Column:
    """Not positive, not 8 characters long, or outside ``lo..hi`` (length tested by range)."""
    x = F.col(c)
    return (x <= 0) | ~has_eight_digits(x) | (x > hi) | (x < lo)


def birthdate_out_of_range(c: str, as_of: str | Column | None = None,
                           earliest: str = codes.MIN_BIRTH_DATE) -> Column:
    now = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date"))
    return (F.col(c) < F.lit(earliest).cast("date")) | (F.col(c) > now)


def null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2: rows with a NULL in any of ``cols``."""
    return df.filter(is_null(cols))


def spaced_rows(df: DataFrame, cols: Sequence[str], collation: str | None = None) -> DataFrame:
    """Q3: whole rows in which any of ``cols`` has leading or trailing spaces (``collation`` as in
    ``has_spaces``)."""
    return df.filter(has_spaces(cols, collation))


def domain(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Q4: distinct value combinations of ``cols``, sorted."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct().orderBy(*[F.col(c).asc_nulls_first() for c in cols])


def negative_rows(df: DataFrame, c: str, keep: Sequence[str] = ()) -> DataFrame:
    """Q5: NULL or negative values of ``c`` (with ``keep`` columns for context)."""
    return df.filter(negative_or_null(c)).select(*keep, c)


def date_order_rows(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Q6: rows where a later date precedes an earlier one."""
    return df.filter(out_of_order(pairs))


def int_date_rows(df: DataFrame, c: str) -> DataFrame:
    """Q7: invalid integer dates, 0 shown as NULL."""
    return df.filter(invalid_int_date(c)).select(F.nullif(F.col(c), F.lit(0)).alias(c))


def inconsistent_sales(sales: str = "sls_sales", quantity: str = "sls_quantity", price: str = "sls_price") -> Column:
    """sales != quantity x price, multiplied as BIGINT: one overflowing row must not end the check."""
    return F.col(sales).cast("bigint") != F.col(quantity).cast("bigint") * F.col(price).cast("bigint")


def sales_consistency(df: DataFrame, sales: str = "sls_sales", quantity: str = "sls_quantity",
                      price: str = "sls_price") -> DataFrame:
    """Q8: distinct (sales, quantity, price) with sales != quantity x price, and their repairs.

    Rows with a NULL in the comparison are not reported (the comparison is unknown).
    """
    s, q, p = F.col(sales), F.col(quantity), F.col(price)
    return (df.filter(inconsistent_sales(sales, quantity, price))
              .select(s.alias(sales), q.alias(quantity), p.alias(price),
                      repaired_sales(s, q.cast("bigint"), p.cast("bigint")).alias(f"{sales}_new"),
                      repaired_price(s, q, p).alias(f"{price}_new"))
              .distinct())


def birthdate_rows(df: DataFrame, c: str = "bdate", as_of: str | Column | None = None) -> DataFrame:
    """Q9: distinct birth dates before 1924-01-01 or in the future."""
    return df.filter(birthdate_out_of_range(c, as_of)).select(c).distinct()


def code_preview(df: DataFrame, c: str, mapping: Mapping[str, str]) -> DataFrame:
    """Q10: distinct raw code -> mapped word."""
    return df.select(F.col(c), map_code(c, mapping).alias(f"{c}_new")).distinct()


# ---- Q11, Q13, Q15: cross-table checks -----------------------------------------------------

def location_orphans(erp_loc: DataFrame, cust: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                     salted: bool = False) -> DataFrame:
    """Q11: location ids (with '-' removed) that are ``NOT IN`` the silver customer keys.

    SQL semantics: a NULL customer key makes the answer empty; no customers keeps every row. ``max_rows`` and
    ``salted`` as in ``absence.not_in``.
    """
    cleaned = erp_loc.select(F.replace(F.col("cid"), F.lit("-"), F.lit("")).alias("cid"), "cntry")
    return not_in(cleaned, "cid", cust, "cst_key", max_rows=max_rows, salted=salted)


def gender_matrix(cust: DataFrame, erp_cust: DataFrame) -> DataFrame:
    """Q13: distinct (CRM gender, ERP gender, integrated gender) after the dimension's joins.

    Each side is reduced to its distinct (key, gender) pairs before the join, so what is joined grows with
    the distinct keys. The location join adds rows but no combinations and is left out.
    """
    people = cust.select("cst_key", "cst_gndr").distinct()
    records = stage(erp_cust.filter(F.col("cid").isNotNull()).select(
        F.col("cid").alias("_tl_ca_cid"), F.col("gen").alias("_tl_gen")).distinct(), "genders")
    joined = lookup_join(people, records.df, [("cst_key", "_tl_ca_cid")], stats=records.stats)
    return joined.select(
        F.col("cst_gndr"), F.col("_tl_gen").alias("gen"),
        integrated_gender(F.col("cst_gndr"), F.col("_tl_gen")).alias("new_gen")).distinct()


def fk_integrity(fact: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame, cust_stats: Stats | None = None,
                 prod_stats: Stats | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Q15: fact rows whose product or customer key finds no dimension row.

    Output: the fact's columns, then the dimensions' columns prefixed ``cust_`` and ``prod_``. Only the
    dimensions' keys meet the whole fact: by broadcast if both are within the bounds, otherwise by Bloom
    filters and lookups of distinct keys (``absence.absent_rows``). The violators are written, and the wide
    columns are attached to those rows alone. ``cust_stats`` / ``prod_stats``: the dimensions' sizes, when known.
    """
    ck = dim_cust.select(F.col("customer_key").alias("_tl_ck"))
    pk = dim_prod.select(F.col("product_key").alias("_tl_pk"))
    if cust_stats is None or prod_stats is None:
        cust_stats, prod_stats = measure_all([dim_cust, dim_prod])
    # a key column: two numbers of eight bytes a row
    size_c, size_p = (Stats(s.rows, 16 * s.rows) for s in (cust_stats, prod_stats))
    if fits_broadcast(size_c, max_rows) and fits_broadcast(size_p, max_rows):
        found = lookup_join(lookup_join(fact, ck, [("customer_key", "_tl_ck")], stats=size_c),
                            pk, [("product_key", "_tl_pk")], stats=size_p)
        bad = found.filter(F.col("_tl_ck").isNull() | F.col("_tl_pk").isNull()).select(*fact.columns)
    else:
        bad = absent_rows(fact, [("customer_key", ck, "_tl_ck"), ("product_key", pk, "_tl_pk")])
    bad = stage(bad, "fk-violators").df
    c = dim_cust.select(*[F.col(x).alias(f"cust_{x}") for x in dim_cust.columns])
    p = dim_prod.select(*[F.col(x).alias(f"prod_{x}") for x in dim_prod.columns])
    with_c = lookup_join(bad, c, [("customer_key", "cust_customer_key")], "left", stats=cust_stats)
    return lookup_join(with_c, p, [("product_key", "prod_product_key")], "left", stats=prod_stats)


# ---- one pass per table --------------------------------------------------------------------

def bronze_rules(as_of: str | Column | None = None) -> dict[str, dict[str, Column]]:
    """Named row rules per bronze table (each a predicate that is TRUE for a bad row)."""
    return {
        "crm_cust_info": {
            "null_id": is_null(["cst_id"]),
            "spaces_firstname": has_spaces(["cst_firstname"]),
            "spaces_lastname": has_spaces(["cst_lastname"]),
        },
        "crm_prd_info": {
            "null_cost": is_null(["prd_cost"]),
            "null_line": is_null(["prd_line"]),
            "negative_or_null_cost": negative_or_null("prd_cost"),
            "end_before_start": out_of_order([("prd_start_dt", "prd_end_dt")]),
            "spaces_name": has_spaces(["prd_nm"]),
        },
        "erp_px_cat_g1v2": {
            "spaces": has_spaces(["cat", "subcat", "maintenance"]),
        },
        "crm_sales_details": {
            "invalid_order_date": invalid_int_date("sls_order_dt"),
            "order_after_ship_or_due": out_of_order([("sls_order_dt", "sls_ship_dt"),
                                                     ("sls_order_dt", "sls_due_dt")]),
            "inconsistent_sales": inconsistent_sales(),
        },
        "erp_cust_az12": {
            "birthdate_out_of_range": birthdate_out_of_range("bdate", as_of),
        },
    }


def rule_counts(df: DataFrame, table_name: str, rules: Mapping[str, Column]) -> DataFrame:
    """All rules of one table counted in one aggregate: rows (table_name, check_name, n_bad)."""
    names = list(rules)
    wide = df.agg(*[F.count_if(F.coalesce(rules[n], F.lit(False))).alias(n) for n in names])
    long = wide.unpivot([], names, "check_name", "n_bad")
    return long.select(F.lit(table_name).alias("table_name"), "check_name", F.col("n_bad").cast("bigint"))


def quality_summary(bronze: Mapping[str, DataFrame], as_of: str | Column | None = None) -> DataFrame:
    """Q2 Q3 Q5 Q6 Q7 Q9 counts for every bronze table present, one scan per table."""
    parts = [rule_counts(bronze[t], t, rules) for t, rules in bronze_rules(as_of).items() if t in bronze]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
