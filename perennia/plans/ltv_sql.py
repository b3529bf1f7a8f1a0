"""Customer lifetime value of the `sql` policy, in Spark SQL over three relations.

It differs from `fold` on purpose: ISO weeks, no rounding, unreadable dates are no week, only
customers with a visit, the rank is given before the join with customer (visitors without a customer
row leave gaps in the ranks), and a customer listed twice appears twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from perennia.operators.lookup import HOT_ROWS, join_unique
from perennia.operators.rank import dense_rank_all, dense_rank_x

# Weeks of the year fit the bits of one long, so the distinct weeks need no second shuffle.
_SCORED = """
WITH visits AS (
  SELECT customer_id,
         count(*) AS total_visits,
         nullif(bit_count(bit_or(shiftleft(1L, weekofyear(event_date)))), 0) AS distinct_weeks
  FROM {site_visit}
  GROUP BY customer_id
), sales AS (
  SELECT customer_id, sum(amount) AS total_amount
  FROM {orders}
  GROUP BY customer_id
)
SELECT v.customer_id,
       v.total_visits,
       v.distinct_weeks,
       s.total_amount,
       coalesce(52 * (CAST(s.total_amount AS DOUBLE) / v.total_visits)
                   * (CAST(v.total_visits AS DOUBLE) / v.distinct_weeks) * 10, 0D) AS ltv
FROM visits v LEFT JOIN sales s ON s.customer_id = v.customer_id
"""


def scored_visitors(site_visit: DataFrame, orders: DataFrame) -> DataFrame:
    """(customer_id, total_visits, distinct_weeks, total_amount, ltv) of every visiting customer."""
    return site_visit.sparkSession.sql(_SCORED, site_visit=site_visit, orders=orders)


def ltv_sql(
    customer: DataFrame,
    site_visit: DataFrame,
    orders: DataFrame,
    k: int | None = None,
    hot_rows: int = HOT_ROWS,
    ranked: bool = False,
) -> DataFrame:
    """Lifetime value of all visiting customers, with their rank if asked for, or of those ranked 1 to k (ties
    included) with the rank.

    `site_visit` has (customer_id, event_date), `orders` (customer_id, amount) and `customer`
    (customer_id, last_name, adr_city, adr_state), the last possibly with repeated ids.
    """
    scored = scored_visitors(site_visit, orders).select("customer_id", "ltv")
    if k is not None:
        scored = dense_rank_x(scored, k)
    elif ranked:
        scored = dense_rank_all(scored)
    ranks = [c for c in scored.columns if c not in ("customer_id", "ltv")]
    # No other columns: the join hashes all it is given.
    people = customer.select("customer_id", "last_name", "adr_city", "adr_state")
    joined = join_unique(people, scored, "customer_id", hot_rows)
    return joined.select(*people.columns, "ltv", *ranks)
