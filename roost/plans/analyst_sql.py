"""Six analyst queries in SQL over the marts.

``{mart}`` stands for the mart: `run` binds it to a DataFrame, `text` to the name of a
registered table. A unique last sort key makes the rows of a limited list certain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class AnalystQuery:
    mart: str
    sql: str

    def run(self, mart: DataFrame, **parameters: str) -> DataFrame:
        return mart.sparkSession.sql(self.sql, args=parameters or None, mart=mart)

    def on_table(self, spark: SparkSession, table: str, **parameters: str) -> DataFrame:
        return spark.sql(self.sql.format(mart=table), args=parameters or None)


QUERIES = {
    "sql_top_reviewed": AnalystQuery(
        "reviews_per_listing",
        """SELECT name, neighbourhood, num_reviews FROM {mart}
           ORDER BY num_reviews DESC, id LIMIT 10""",
    ),
    "sql_top_rated_min5": AnalystQuery(
        "avg_rating_per_listing",
        """SELECT name, avg_rating, num_reviews FROM {mart} WHERE num_reviews >= 5
           ORDER BY avg_rating DESC, id LIMIT 10""",
    ),
    "sql_neighbourhood_volume": AnalystQuery(
        "reviews_per_neighbourhood",
        """SELECT neighbourhood, num_listings, num_reviews, avg_rating FROM {mart}
           ORDER BY num_reviews DESC, neighbourhood""",
    ),
    "sql_month_top_earners": AnalystQuery(
        "revenue_by_listing_month",
        """SELECT name, neighbourhood, num_bookings, total_revenue FROM {mart}
           WHERE checkin_month = :month ORDER BY total_revenue DESC, id LIMIT 10""",
    ),
    "sql_weakest_conversion": AnalystQuery(
        "booking_conversion",
        """SELECT name, total_bookings, conversion_rate, cancellation_rate FROM {mart}
           WHERE total_bookings >= 5 ORDER BY conversion_rate, id LIMIT 10""",
    ),
    "sql_payment_reliability": AnalystQuery(
        "transaction_success_rates",
        """SELECT payment_method, total_txns, success_rate, settled_amount FROM {mart}
           ORDER BY total_txns DESC, payment_method""",
    ),
}
