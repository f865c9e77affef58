"""The sample customers and orders whose results are known."""

# customer_id, total_purchases, loyalty_tier
CUSTOMERS = [
    (1001, "15420.50", "Gold"),
    (1002, "8750.25", "Silver"),
    (1003, "22340.75", "Platinum"),
    (1004, "12890.00", "Gold"),
    (1005, "5420.30", "Bronze"),
    (1006, "18750.60", "Gold"),
    (1007, "9340.80", "Silver"),
    (1008, "25670.90", "Platinum"),
    (1009, "7890.45", "Silver"),
    (1010, "14230.20", "Gold"),
    (1011, "31250.75", "Platinum"),
    (1012, "11450.30", "Gold"),
    (1013, "6780.50", "Bronze"),
    (1014, "13560.40", "Gold"),
    (1015, "9870.65", "Silver"),
    (1016, "16340.85", "Gold"),
    (1017, "19450.20", "Gold"),
    (1018, "8920.75", "Silver"),
    (1019, "7230.90", "Silver"),
    (1020, "21890.35", "Platinum"),
    (1021, "10560.80", "Silver"),
    (1022, "28340.50", "Platinum"),
    (1023, "6450.25", "Bronze"),
    (1024, "15780.40", "Gold"),
    (1025, "11230.60", "Gold"),
    (1026, "8340.75", "Silver"),
    (1027, "7890.30", "Silver"),
    (1028, "19670.85", "Gold"),
    (1029, "5670.40", "Bronze"),
    (1030, "13450.95", "Gold"),
]

# order_id, customer_id, order_date, total_amount, order_status
ORDERS = [
    (10001, 1001, "2024-01-15", "1299.99", "Delivered"),
    (10002, 1002, "2024-01-16", "59.98", "Delivered"),
    (10003, 1003, "2024-01-17", "349.99", "Delivered"),
    (10004, 1001, "2024-01-18", "59.97", "Delivered"),
    (10005, 1004, "2024-01-19", "79.99", "Delivered"),
    (10006, 1005, "2024-01-20", "1299.99", "Shipped"),
    (10007, 1006, "2024-01-21", "149.99", "Delivered"),
    (10008, 1007, "2024-01-22", "799.98", "Delivered"),
    (10009, 1008, "2024-01-23", "89.99", "Delivered"),
    (10010, 1009, "2024-01-24", "199.99", "Delivered"),
    (10011, 1010, "2024-01-25", "599.99", "Delivered"),
    (10012, 1011, "2024-01-26", "2599.98", "Delivered"),
    (10013, 1012, "2024-01-27", "449.99", "Delivered"),
    (10014, 1013, "2024-01-28", "29.99", "Delivered"),
    (10015, 1014, "2024-01-29", "299.99", "Delivered"),
    (10016, 1015, "2024-01-30", "259.98", "Delivered"),
    (10017, 1016, "2024-02-01", "179.99", "Delivered"),
    (10018, 1017, "2024-02-02", "59.99", "Delivered"),
    (10019, 1018, "2024-02-03", "349.99", "Delivered"),
    (10020, 1019, "2024-02-04", "49.99", "Delivered"),
    (10021, 1020, "2024-02-05", "1299.99", "Delivered"),
    (10022, 1021, "2024-02-06", "79.98", "Delivered"),
    (10023, 1022, "2024-02-07", "1199.97", "Delivered"),
    (10024, 1023, "2024-02-08", "24.99", "Delivered"),
    (10025, 1024, "2024-02-09", "19.99", "Delivered"),
    (10026, 1025, "2024-02-10", "129.99", "Delivered"),
    (10027, 1026, "2024-02-11", "149.99", "Delivered"),
    (10028, 1027, "2024-02-12", "79.99", "Delivered"),
    (10029, 1028, "2024-02-13", "99.98", "Delivered"),
    (10030, 1029, "2024-02-14", "14.99", "Shipped"),
    (10031, 1030, "2024-02-15", "39.99", "Delivered"),
    (10032, 1001, "2024-02-16", "89.99", "Delivered"),
    (10033, 1003, "2024-02-17", "299.99", "Delivered"),
    (10034, 1006, "2024-02-18", "129.99", "Delivered"),
    (10035, 1008, "2024-02-19", "349.99", "Delivered"),
    (10036, 1011, "2024-02-20", "79.99", "Delivered"),
    (10037, 1014, "2024-02-21", "189.99", "Delivered"),
    (10038, 1017, "2024-02-22", "149.99", "Delivered"),
    (10039, 1020, "2024-02-23", "99.99", "Delivered"),
    (10040, 1022, "2024-02-24", "59.99", "Delivered"),
    (10041, 1024, "2024-02-25", "79.99", "Delivered"),
    (10042, 1028, "2024-02-26", "199.99", "Delivered"),
    (10043, 1002, "2024-02-27", "249.99", "Delivered"),
    (10044, 1004, "2024-02-28", "499.99", "Processing"),
    (10045, 1007, "2024-02-29", "89.97", "Shipped"),
    (10046, 1010, "2024-03-01", "89.99", "Delivered"),
    (10047, 1012, "2024-03-02", "49.99", "Delivered"),
    (10048, 1015, "2024-03-03", "299.99", "Delivered"),
    (10049, 1016, "2024-03-04", "79.99", "Delivered"),
    (10050, 1019, "2024-03-05", "39.99", "Delivered"),
]
