import pytest

from riskmart.plans.market_silver import dim_products, fact_orders, fact_payments, fact_reviews
from riskmart.sources.csv_snapshot import read_csv

HEADER = {
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state",
    "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value",
    "orders": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date"
    ),
    "order_reviews": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp"
    ),
}


def write(tmp_path, table, body, bom=False):
    path = tmp_path / f"{table}.csv"
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + f"{HEADER[table]}\n{body}".encode())
    return str(path)


@pytest.mark.parametrize("bom", [True, False])
def test_byte_order_mark(spark, tmp_path, bom):
    frame = read_csv(spark, "sellers", write(tmp_path, "sellers", "s1,123,São Paulo,SP\n", bom))
    row = frame.first()
    assert (row.seller_id, row.seller_city) == ("s1", "São Paulo")
    assert row._source_file.endswith("sellers.csv") and row._ingested_at is not None


def test_malformed_row_stops_the_read(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, "sellers", write(tmp_path, "sellers", "s1,123,city,SP,extra\n")).collect()


def test_reordered_header_stops_the_read(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_zip_code_prefix,seller_id,seller_city,seller_state\n123,s1,city,SP\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, "sellers", str(path)).collect()


def test_free_text_reviews(spark, tmp_path):
    body = (
        'r1,o1,5,"  ","line one\nsays ""hi"", twice",2024-01-01 00:00:00,2024-01-02 00:00:00\n'
        "r1,o1,4,late,,2024-01-01 00:00:00,2024-01-03 00:00:00\n"
        "r2,o1,3,x,y,bad date,2024-01-03 00:00:00\n"
    )
    raw = read_csv(spark, "order_reviews", write(tmp_path, "order_reviews", body))
    assert raw.filter("review_score = '5'").first().review_comment_message == 'line one\nsays "hi", twice'
    kept = {r.review_id: r for r in fact_reviews(raw).collect()}
    assert (kept["r1"].review_score, kept["r1"].review_title, kept["r1"].review_message) == (4, "late", None)
    assert kept["r2"].review_created_at is None
    first_only = fact_reviews(raw.filter("review_score = '5'")).first()
    assert first_only.review_title is None


def test_bad_text_becomes_null_and_mandatory_keys_stay(spark, tmp_path):
    body = "o1,1,credit_card,many,10.00\no1,2, boleto ,2,free\no1,3,x,1,-1\n,4,x,1,5\no2,1,x,1,0.00\n"
    rows = fact_payments(read_csv(spark, "order_payments", write(tmp_path, "order_payments", body)))
    found = sorted((r.order_id, r.payment_type, r.installments, str(r.payment_value_brl)) for r in rows.collect())
    assert found == [("o1", "CREDIT_CARD", None, "10.00"), ("o2", "X", 1, "0.00")]


def test_orders_are_distinct_and_need_a_purchase_time(spark, tmp_path):
    line = "o1,c1, Delivered ,2024-01-01 10:00:00,,,,2024-01-09 00:00:00\n"
    rows = fact_orders(read_csv(spark, "orders", write(tmp_path, "orders", line * 2 + "o2,c2,created,,,,,\n"))).collect()
    assert [(r.order_id, r.order_status, r.approved_at) for r in rows] == [("o1", "delivered", None)]


def test_product_categories(spark):
    products = spark.sql(
        "SELECT * FROM VALUES ('a', 'casa', '3'), ('b', 'nova', 'x'), ('c', NULL, NULL) "
        "AS v(product_id, product_category_name, product_name_lenght)"
    )
    for column in (
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ):
        products = products.selectExpr("*", f"'1' AS {column}")
    translation = spark.sql("SELECT 'casa' AS product_category_name, 'home' AS product_category_name_english")
    rows = {r.product_id: (r.category, r.name_length) for r in dim_products(products, translation).collect()}
    assert rows == {"a": ("home", 3), "b": ("nova", None), "c": ("unknown", None)}
