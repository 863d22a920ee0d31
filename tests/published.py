"""Results published for the public marketplace data set, used as expected values."""

# order_month, orders, delivered, canceled, otif_rate_pct, revenue_brl, avg_review_score
MONTHS = [
    ("2016-09", 4, 1, 2, 0.0, 252.24, 1.0),
    ("2016-10", 324, 265, 24, 99.25, 59090.48, 3.56),
    ("2016-12", 1, 1, 0, 100.0, 19.62, 5.0),
    ("2017-01", 800, 750, 3, 97.07, 138488.04, 4.06),
    ("2017-02", 1780, 1653, 17, 97.04, 291908.01, 4.02),
    ("2017-03", 2682, 2546, 33, 95.44, 449863.6, 4.07),
    ("2017-04", 2404, 2303, 18, 93.44, 417788.03, 4.05),
    ("2017-05", 3700, 3546, 29, 97.01, 592918.82, 4.14),
    ("2017-06", 3245, 3135, 16, 96.97, 511276.38, 4.15),
    ("2017-07", 4026, 3872, 28, 97.21, 592382.92, 4.17),
    ("2017-08", 4331, 4193, 27, 97.09, 674396.32, 4.24),
    ("2017-09", 4285, 4150, 20, 95.61, 727762.45, 4.19),
    ("2017-10", 4631, 4478, 26, 95.82, 779677.88, 4.12),
    ("2017-11", 7544, 7289, 37, 87.6, 1194882.8, 3.91),
    ("2017-12", 5673, 5513, 11, 92.54, 878401.48, 4.02),
    ("2018-01", 7269, 7069, 34, 94.3, 1115004.18, 4.04),
    ("2018-02", 6728, 6555, 73, 85.87, 992463.34, 3.83),
    ("2018-03", 7211, 7003, 26, 81.04, 1159652.12, 3.75),
    ("2018-04", 6939, 6798, 15, 95.5, 1160785.48, 4.16),
    ("2018-05", 6873, 6749, 24, 93.44, 1153982.15, 4.19),
    ("2018-06", 6167, 6099, 18, 98.84, 1023880.5, 4.28),
    ("2018-07", 6292, 6159, 41, 96.62, 1066540.75, 4.26),
    ("2018-08", 6512, 6351, 84, 93.81, 1022425.32, 4.26),
    ("2018-09", 16, 0, 15, None, 4439.54, 1.8),
    ("2018-10", 4, 0, 4, None, 589.67, 2.25),
]
MONTH_COLUMNS = """order_month STRING, orders BIGINT, delivered BIGINT, canceled BIGINT,
    otif_rate_pct DOUBLE, revenue_brl DOUBLE, avg_review_score DOUBLE"""

# seller_state, orders, avg_delivery_days, otif_rate_pct, avg_review_score
STATES = [
    ("SP", 68641, 12.3, 92.69, 4.12), ("MG", 7735, 12.8, 95.2, 4.23), ("PR", 7512, 13.3, 94.65, 4.18),
    ("RJ", 4227, 12.0, 92.88, 4.22), ("SC", 3603, 13.6, 95.14, 4.17), ("RS", 1962, 11.4, 96.89, 4.32),
    ("DF", 808, 12.4, 94.68, 4.1), ("BA", 550, 13.8, 95.09, 4.19), ("GO", 451, 12.8, 97.12, 4.38),
    ("PE", 403, 12.7, 96.28, 4.26), ("MA", 389, 17.6, 80.98, 4.01), ("ES", 310, 13.0, 93.87, 4.15),
    ("MT", 136, 14.7, 96.32, 4.21), ("CE", 87, 17.7, 93.1, 4.29), ("RN", 51, 13.0, 92.16, 4.27),
    ("MS", 49, 12.1, 93.88, 4.46), ("PB", 35, 12.6, 97.14, 3.91), ("RO", 14, 17.4, 100.0, 3.86),
    ("PI", 11, 13.7, 100.0, 4.36), ("SE", 9, 12.6, 100.0, 3.78), ("PA", 8, 13.3, 100.0, 4.5),
    ("AM", 3, 48.0, 66.67, 2.33),
]
STATE_COLUMNS = """seller_state STRING, orders BIGINT, avg_delivery_days DOUBLE, otif_rate_pct DOUBLE,
    avg_review_score DOUBLE"""

# category, revenue_brl: the first eleven
CATEGORIES = [
    ("health_beauty", 1448729.73), ("watches_gifts", 1310893.45), ("bed_bath_table", 1265918.38),
    ("sports_leisure", 1166060.5), ("computers_accessories", 1066263.82),
    ("furniture_decor", 932339.78), ("housewares", 793238.51), ("cool_stuff", 729806.15),
    ("auto", 688628.01), ("garden_tools", 596759.43), ("toys", 566925.14),
]
CATEGORY_COLUMNS = "category STRING, revenue_brl DOUBLE"

TOTAL_DELIVERED, OTIF = 96478, 93.23
