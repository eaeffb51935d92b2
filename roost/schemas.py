"""Column lists of every stored table, as DDL text. Names and types
are the interface that existing files and queries rely on."""

# Raw records: numbers and dates arrive as text and are cast by the cleaners.
RAW = {
    "listings": "id BIGINT, name STRING, host_id BIGINT, neighbourhood STRING, "
    "room_type STRING, price STRING, minimum_nights STRING",
    "reviews": "id BIGINT, listing_id BIGINT, date STRING, reviewer_id BIGINT, "
    "reviewer_name STRING, rating STRING, comments STRING",
    "bookings": "booking_id BIGINT, listing_id BIGINT, guest_id BIGINT, checkin_date STRING, "
    "checkout_date STRING, nights STRING, amount STRING, status STRING",
    "transactions": "txn_id BIGINT, booking_id BIGINT, ts STRING, amount STRING, "
    "currency STRING, payment_method STRING, status STRING",
}

# Clean tables, without their partition column.
CLEAN = {
    "listings": "id BIGINT, name STRING, host_id BIGINT, neighbourhood STRING, "
    "room_type STRING, price DOUBLE, minimum_nights INT",
    "reviews": "id BIGINT, listing_id BIGINT, reviewer_id BIGINT, reviewer_name STRING, "
    "rating INT, comments STRING, review_date DATE",
    "bookings": "booking_id BIGINT, listing_id BIGINT, guest_id BIGINT, checkin_date DATE, "
    "checkout_date DATE, nights INT, amount DOUBLE, status STRING",
    "transactions": "txn_id BIGINT, booking_id BIGINT, ts TIMESTAMP, amount DOUBLE, "
    "currency STRING, payment_method STRING, status STRING",
}
CLEAN_PARTITION = {
    "listings": None,
    "reviews": "review_month STRING",
    "bookings": "checkin_month STRING",
    "transactions": "txn_date DATE",
}

# Marts, without their partition column.
MARTS = {
    "reviews_per_listing": "id BIGINT, name STRING, neighbourhood STRING, num_reviews BIGINT",
    "avg_rating_per_listing": "id BIGINT, name STRING, avg_rating DOUBLE, num_reviews BIGINT",
    "reviews_per_neighbourhood": "neighbourhood STRING, num_reviews BIGINT, avg_rating DOUBLE, "
    "num_listings BIGINT",
    "revenue_by_listing_month": "id BIGINT, name STRING, neighbourhood STRING, "
    "num_bookings BIGINT, total_nights BIGINT, total_revenue DOUBLE",
    "booking_conversion": "id BIGINT, name STRING, total_bookings BIGINT, completed BIGINT, "
    "confirmed BIGINT, cancelled BIGINT, conversion_rate DOUBLE, cancellation_rate DOUBLE",
    "transaction_success_rates": "payment_method STRING, total_txns BIGINT, succeeded BIGINT, "
    "failed BIGINT, refunded BIGINT, settled_amount DOUBLE, success_rate DOUBLE",
}
MART_PARTITION = {"revenue_by_listing_month": "checkin_month STRING"}

# Order of the rows of each mart; the last column settles ties.
MART_ORDER = {
    "reviews_per_listing": "num_reviews DESC, id",
    "avg_rating_per_listing": "avg_rating DESC, num_reviews DESC, id",
    "reviews_per_neighbourhood": "num_reviews DESC, neighbourhood",
    "revenue_by_listing_month": "total_revenue DESC, id, checkin_month",
    "booking_conversion": "total_bookings DESC, id",
    "transaction_success_rates": "total_txns DESC, payment_method",
}
