"""The market tables again, in the SQL of the checking database.

Every check query starts with these views. They are written independently of the jobs: keys are
global row numbers, medians are the database's own.
"""

_SCORES = "\n".join(
    f"        CASE WHEN o_orderkey % 3 <> 0 THEN 3.0::DOUBLE + (o_orderkey * {factor} % 129) / 64.0::DOUBLE END "
    f"AS review_scores_{name},"
    for name, factor in (
        ("rating", 37),
        ("accuracy", 41),
        ("cleanliness", 43),
        ("checkin", 47),
        ("communication", 53),
        ("location", 59),
        ("value", 61),
    )
)

VIEWS = f"""
WITH listings AS (
    SELECT
        o_orderkey AS id,
        'Listing ' || o_orderkey AS name,
        'Stay with ' || c_name AS description,
        o_custkey AS host_id,
        c_name AS host_name,
        CASE WHEN o_custkey % 29 <> 0
             THEN CAST(min(o_orderdate) OVER (PARTITION BY o_custkey) AS DATE) END AS host_since,
        CASE WHEN c_acctbal >= 0 THEN c_acctbal > 5000 END AS host_is_superhost,
        CAST(1 + o_custkey * 7 % 13 + o_custkey % 3 AS DOUBLE) AS host_total_listings_count,
        n_name AS neighbourhood_cleansed,
        r_name AS neighbourhood_group_cleansed,
        13.0::DOUBLE + (o_orderkey % 1000) / 1000.0::DOUBLE AS latitude,
        CASE WHEN o_orderkey % 71 <> 0
             THEN 100.0::DOUBLE + (o_orderkey % 700) / 1000.0::DOUBLE END AS longitude,
        o_orderstatus AS property_type,
        o_orderpriority AS room_type,
        CAST(1 + o_orderkey % 8 AS INTEGER) AS accommodates,
        1.0::DOUBLE + (o_orderkey % 4) / 2.0::DOUBLE AS bathrooms,
        (1 + o_orderkey % 4) || ' baths' AS bathrooms_text,
        CASE WHEN o_orderkey % 6 <> 5 THEN CAST(o_orderkey % 6 AS DOUBLE) END AS bedrooms,
        CASE WHEN o_orderkey % 17 <> 0 THEN CAST(1 + o_orderkey % 5 AS DOUBLE) END AS beds,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL
             WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE
             ELSE floor(o_totalprice) END AS price,
        CAST(1 + o_orderkey % 30 AS INTEGER) AS minimum_nights,
        CAST(30 + o_orderkey % 1000 AS INTEGER) AS maximum_nights,
        CAST(o_orderkey * 7 % 31 AS INTEGER) AS availability_30,
        CAST(o_orderkey * 11 % 61 AS INTEGER) AS availability_60,
        CAST(o_orderkey * 17 % 91 AS INTEGER) AS availability_90,
        CAST(o_orderkey * 31 % 366 AS INTEGER) AS availability_365,
        CAST(o_orderkey * 13 % 50 AS INTEGER) AS number_of_reviews,
        CAST(o_orderkey * 13 % 50 % 12 AS INTEGER) AS number_of_reviews_ltm,
        CASE WHEN o_orderkey * 13 % 50 <> 0
             THEN DATE '2001-01-01' + CAST(o_orderkey % 365 AS INTEGER) END AS last_review,
{_SCORES}
        CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey % 4 = 0 END AS instant_bookable,
        CAST(1 + o_custkey * 7 % 13 AS INTEGER) AS calculated_host_listings_count,
        CASE WHEN o_orderkey * 13 % 50 = 0 THEN 0.0::DOUBLE
             WHEN o_orderkey % 10 <> 0 THEN 0.25::DOUBLE + (o_orderkey % 40) / 8.0::DOUBLE
        END AS reviews_per_month
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
),
calendar AS (
    SELECT
        l_orderkey AS listing_id,
        CASE WHEN (l_orderkey + l_linenumber) % 211 <> 0 THEN CAST(l_shipdate AS DATE) END AS date,
        CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS available,
        CASE WHEN l_linenumber = 7 THEN NULL
             WHEN l_orderkey % 89 = 0 THEN 0.0::DOUBLE
             ELSE floor(l_extendedprice) END AS price,
        floor(l_extendedprice * (1 - l_discount)) AS adjusted_price,
        CAST(l_quantity AS INTEGER) AS minimum_nights,
        1125 AS maximum_nights
    FROM lineitem
),
reviews AS (
    SELECT user_id AS listing_id, event_id AS id, CAST(ts AS DATE) AS date,
           event_id % 97 AS reviewer_id, event_type AS reviewer_name, props AS comments
    FROM events
),
neighbourhoods AS (
    SELECT r_name AS neighbourhood_group, n_name AS neighbourhood
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
calendar_agg AS (
    SELECT listing_id,
           count(available) AS calendar_days_total,
           count(*) FILTER (WHERE available IS NOT TRUE) AS calendar_days_unavailable,
           round_even(avg(price) * 100, 0) / 100 AS average_calendar_price,
           CASE WHEN count(available) > 0 THEN
               round_even(count(*) FILTER (WHERE available IS NOT TRUE)::DOUBLE / count(available)::DOUBLE * 10000, 0)
               / 10000 END AS estimated_occupancy_rate_365d
    FROM calendar WHERE listing_id IS NOT NULL GROUP BY listing_id
),
review_agg AS (
    SELECT listing_id, count(id) AS total_review_count, min(date) AS review_first_date, max(date) AS review_last_date
    FROM reviews WHERE listing_id IS NOT NULL GROUP BY listing_id
),
enriched AS (
    SELECT l.*,
           c.calendar_days_total, c.calendar_days_unavailable, c.average_calendar_price,
           c.estimated_occupancy_rate_365d,
           r.total_review_count, r.review_first_date, r.review_last_date,
           round_even(date_diff('day', l.host_since, DATE '2001-12-31')::DOUBLE / 365.25::DOUBLE * 10, 0) / 10
               AS host_tenure_years,
           CASE WHEN l.bedrooms > 0 THEN round_even(l.price / l.bedrooms * 100, 0) / 100 END AS price_per_bedroom,
           coalesce(l.calculated_host_listings_count >= 3, false) AS is_professional_host,
           CASE WHEN coalesce(l.calculated_host_listings_count, 1) <= 0 THEN NULL
                WHEN coalesce(l.calculated_host_listings_count, 1) <= 1 THEN 'Solo Host'
                WHEN l.calculated_host_listings_count <= 2 THEN 'Small Portfolio'
                WHEN l.calculated_host_listings_count <= 9 THEN 'Mid Portfolio'
                ELSE 'Commercial Operator' END AS host_tier,
           round_even(c.average_calendar_price * c.calendar_days_unavailable * 100, 0) / 100
               AS estimated_annual_revenue_proxy
    FROM listings l
    LEFT JOIN calendar_agg c ON l.id = c.listing_id
    LEFT JOIN review_agg r ON l.id = r.listing_id
),
dim_neighbourhood AS (
    SELECT row_number() OVER (ORDER BY neighbourhood) AS neighbourhood_key,
           neighbourhood AS neighbourhood_name, min(neighbourhood_group) AS neighbourhood_group
    FROM neighbourhoods GROUP BY neighbourhood
),
host_rows AS (
    SELECT DISTINCT ON (host_id) host_id, host_name, host_since, host_tenure_years, host_is_superhost,
           CAST(host_total_listings_count AS INTEGER) AS host_total_listings_count,
           calculated_host_listings_count, is_professional_host, coalesce(host_tier, 'nan') AS host_tier
    FROM enriched ORDER BY host_id, id
),
dim_host AS (
    SELECT row_number() OVER (ORDER BY host_id) AS host_key, * FROM host_rows
),
dim_listing AS (
    SELECT row_number() OVER (ORDER BY e.id) AS listing_key, e.id AS listing_id, e.name, e.description,
           n.neighbourhood_key, h.host_key, e.latitude, e.longitude, e.property_type, e.room_type,
           e.accommodates, e.bedrooms, e.beds, e.bathrooms_text, e.minimum_nights, e.maximum_nights,
           e.instant_bookable
    FROM enriched e
    LEFT JOIN dim_neighbourhood n ON e.neighbourhood_cleansed = n.neighbourhood_name
    LEFT JOIN dim_host h ON e.host_id = h.host_id
),
dim_date AS (
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
           CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
           CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
           isodow(d) IN (6, 7) AS is_weekend, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter
    FROM (SELECT DISTINCT date AS d FROM calendar WHERE date IS NOT NULL)
),
fact_listing_snapshot AS (
    SELECT k.listing_key, e.price, e.price_per_bedroom, e.number_of_reviews, e.number_of_reviews_ltm,
           e.review_scores_rating, e.review_scores_accuracy, e.review_scores_cleanliness,
           e.review_scores_checkin, e.review_scores_communication, e.review_scores_location,
           e.review_scores_value, e.reviews_per_month, e.availability_30, e.availability_60,
           e.availability_90, e.availability_365, e.estimated_occupancy_rate_365d,
           e.average_calendar_price, e.estimated_annual_revenue_proxy
    FROM enriched e
    LEFT JOIN (SELECT listing_id, max(listing_key) AS listing_key FROM dim_listing GROUP BY listing_id) k
        ON e.id = k.listing_id
),
fact_calendar AS (
    SELECT listing_id, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, available, price,
           adjusted_price, minimum_nights, maximum_nights
    FROM calendar
),
fact_reviews AS (
    SELECT id AS review_id, listing_id, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
           reviewer_id, reviewer_name
    FROM reviews
)
"""
