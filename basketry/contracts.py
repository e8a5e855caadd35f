"""Data contracts of the five retail entities and the fixed value lists.

A contract is a plain ``StructType`` that is a superset of every version of
the payload: a field a producer does not send yet decodes to null.
Numbers that may arrive as ``1.0`` or ``1`` are DOUBLE on the wire and are
narrowed after decoding, because ``from_json`` nulls ``1.0`` read as INT.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE, BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CONTRACTS: dict[str, T.StructType] = {
    "customers": _struct(
        customer_id=STRING, name=STRING, age=DOUBLE, gender=STRING, city=STRING,
        signup_date=STRING, phone=STRING, email=STRING,
    ),
    "products": _struct(
        product_id=STRING, product_name=STRING, category=STRING, brand=STRING,
        price=DOUBLE, description=STRING,
    ),
    "orders": _struct(
        order_seq=DOUBLE, order_id=STRING, customer_id=STRING, product_id=STRING,
        quantity=DOUBLE, price=DOUBLE, discount=DOUBLE, payment_method=STRING,
        order_status=STRING, city=STRING, state=STRING, country=STRING,
        event_time=STRING, amount=DOUBLE, ingestion_time=STRING,
        is_late_arrival=BOOL, coupon_code=STRING,
    ),
    "payments": _struct(
        payment_id=STRING, order_id=STRING, payment_method=STRING,
        payment_status=STRING, amount=DOUBLE,
    ),
    "shipping": _struct(
        shipment_id=STRING, order_id=STRING, courier=STRING, delivery_status=STRING,
    ),
}

ENTITIES = tuple(CONTRACTS)

# Typed order view used by the stream preview. The two foreign ids are part of
# the contract although orders never carry them, so they decode to null.
ORDER_PREVIEW = T.StructType([
    T.StructField("order_id", STRING),
    T.StructField("customer_id", STRING),
    T.StructField("product_id", STRING),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("amount", DOUBLE),
    T.StructField("payment_id", STRING),
    T.StructField("shipment_id", STRING),
    T.StructField("event_time", T.TimestampType()),
])

ENVELOPE = T.StructType([
    T.StructField("message_key", STRING),
    T.StructField("value", STRING),
    T.StructField("topic", STRING),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", LONG),
    T.StructField("timestamp", T.TimestampType()),
])

PRIMARY_KEY = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "payments": "payment_id",
    "shipping": "shipment_id",
}

# (child entity, column, parent entity)
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers"),
    ("orders", "product_id", "products"),
    ("payments", "order_id", "orders"),
    ("shipping", "order_id", "orders"),
)

# ---------------------------------------------------------------------------
# These lists must equal the published ones for right results.
# ---------------------------------------------------------------------------

NULL_TEXTS = ("NaT", "", "null")

FAILED_PAYMENT_STATUSES = ("Failed", "ERROR", "unknown_status")
UNDELIVERED_STATUSES = ("Pending", "Failed")

CITY_STATE = {
    "Delhi": "Delhi",
    "Mumbai": "Maharashtra",
    "Bengaluru": "Karnataka",
    "Hyderabad": "Telangana",
    "Pune": "Maharashtra",
    "Chennai": "Tamil Nadu",
    "Kolkata": "West Bengal",
    "Jaipur": "Rajasthan",
    "Lucknow": "Uttar Pradesh",
    "Ahmedabad": "Gujarat",
    "Chandigarh": "Chandigarh",
    "Kochi": "Kerala",
    "Indore": "Madhya Pradesh",
    "Surat": "Gujarat",
    "Nagpur": "Maharashtra",
}
DEFAULT_STATE = "Delhi"

# (product name, category, brand, lowest price, highest price)
PRODUCT_CATALOG = (
    ("iPhone 15", "Electronics", "Apple", 75000, 85000),
    ("iPhone 15 Pro", "Electronics", "Apple", 110000, 135000),
    ("Galaxy S25", "Electronics", "Samsung", 70000, 90000),
    ("Galaxy A55", "Electronics", "Samsung", 28000, 35000),
    ("MacBook Air", "Electronics", "Apple", 99000, 120000),
    ("MacBook Pro", "Electronics", "Apple", 150000, 220000),
    ("HP Pavilion", "Electronics", "HP", 55000, 75000),
    ("HP Laptop 15", "Electronics", "HP", 45000, 60000),
    ("Dell XPS 13", "Electronics", "Dell", 90000, 130000),
    ("boAt Earbuds", "Electronics", "boAt", 1200, 3500),
    ("Sony Headphones", "Electronics", "Sony", 5000, 25000),
    ("Nike Air Shoes", "Fashion", "Nike", 3500, 8000),
    ("Nike Running Shoes", "Fashion", "Nike", 2500, 6000),
    ("Adidas T-Shirt", "Fashion", "Adidas", 999, 2500),
    ("Adidas Track Pants", "Fashion", "Adidas", 1500, 3200),
    ("Levi's Jeans", "Fashion", "Levi's", 1800, 4200),
    ("Levi's Jacket", "Fashion", "Levi's", 3000, 6500),
    ("Puma Sneakers", "Fashion", "Puma", 2200, 5500),
    ("Office Chair", "Furniture", "IKEA", 6000, 12000),
    ("Study Table", "Furniture", "IKEA", 8000, 15000),
    ("Sofa Set 3-Seater", "Furniture", "Urban Ladder", 25000, 55000),
    ("Bookshelf", "Furniture", "IKEA", 4000, 9000),
    ("Coffee Maker", "Home Appliances", "Philips", 2500, 5000),
    ("Air Fryer", "Home Appliances", "Philips", 4000, 9000),
    ("Microwave Oven", "Home Appliances", "LG", 8000, 16000),
    ("Refrigerator 250L", "Home Appliances", "Samsung", 22000, 38000),
    ("Washing Machine", "Home Appliances", "LG", 20000, 42000),
    ("Face Wash Combo", "Beauty", "Nivea", 300, 900),
    ("Perfume 100ml", "Beauty", "Fogg", 500, 1500),
    ("Hair Dryer", "Beauty", "Philips", 800, 2200),
    ("Yoga Mat", "Sports", "Decathlon", 500, 1500),
    ("Dumbbell Set 10kg", "Sports", "Decathlon", 1500, 3500),
    ("Cricket Bat", "Sports", "SG", 1200, 4500),
    ("Novel - Fiction", "Books", "Penguin", 250, 600),
    ("Self Help Book", "Books", "HarperCollins", 300, 700),
)
COUNTRY = "India"
AGES = (18, 65)
SIGNUP_WINDOW_DAYS = 3 * 365

PAYMENT_METHODS = {
    "UPI": 0.42, "Credit Card": 0.18, "Debit Card": 0.15,
    "Net Banking": 0.10, "Cash on Delivery": 0.15,
}
ORDER_STATUSES = {
    "Delivered": 0.62, "Shipped": 0.15, "Processing": 0.10,
    "Cancelled": 0.08, "Returned": 0.05,
}
GENDERS = {"Male": 0.49, "Female": 0.49, "Other": 0.02}
DISCOUNTS = {0: 0.35, 5: 0.22, 10: 0.18, 15: 0.12, 20: 0.07, 25: 0.04, 30: 0.02}
QUANTITIES = {1: 0.55, 2: 0.25, 3: 0.10, 4: 0.06, 5: 0.04}
HOURS = dict(enumerate((
    0.01, 0.01, 0.01, 0.01, 0.01, 0.01,
    0.02, 0.03, 0.04, 0.05, 0.05, 0.05,
    0.06, 0.05, 0.05, 0.05, 0.05, 0.05,
    0.07, 0.08, 0.09, 0.08, 0.05, 0.03,
)))
COURIERS = ("Delhivery", "BlueDart", "Ekart", "DTDC", "XpressBees", "Shadowfax")
COUPONS = ("SAVE5", "SAVE10", "SAVE15", "SAVE20")
COUPON_SHARE = 0.30
SAME_CITY_SHARE = 0.85
ORDER_WINDOW_DAYS = 120

# payment status given the order status; "*" is every other status
PAYMENT_OUTCOMES = {
    "Cancelled": {"Refunded": 0.6, "Failed": 0.3, "Success": 0.1},
    "Returned": {"Refunded": 0.8, "Success": 0.2},
    "*": {"Success": 0.92, "Pending": 0.05, "Failed": 0.03},
}
DELIVERY_OUTCOMES = {
    "Delivered": {"Delivered": 1.0},
    "Cancelled": {"Failed": 1.0},
    "Returned": {"Delivered": 0.7, "Failed": 0.3},
    "Shipped": {"In Transit": 0.6, "Out for Delivery": 0.4},
    "*": {"Pending": 1.0},
}

PAYMENT_METHOD_SPELLINGS = {
    "UPI": ["upi", "Upi", "UPI ", "UPI Payment", "U.P.I"],
    "Credit Card": ["credit card", "CREDIT CARD", "CreditCard", "Credit-Card"],
    "Debit Card": ["debit card", "DEBIT CARD", "DebitCard"],
    "Net Banking": ["net banking", "NETBANKING", "Net-Banking"],
    "Cash on Delivery": ["cod", "COD", "cash on delivery", "Cash On Delivery"],
}
CITY_SPELLINGS = {
    "Delhi": ["DELHI", "delhi", "New Delhi", "New delhi"],
    "Mumbai": ["MUMBAI", "mumbai", "Bombay"],
    "Bengaluru": ["Bangalore", "BENGALURU", "bengaluru"],
    "Hyderabad": ["HYDERABAD", "hyderabad"],
    "Pune": ["PUNE", "pune", "Poona"],
    "Chennai": ["CHENNAI", "chennai", "Madras"],
    "Kolkata": ["KOLKATA", "kolkata", "Calcutta"],
    "Jaipur": ["JAIPUR", "jaipur"],
    "Lucknow": ["LUCKNOW", "lucknow"],
    "Ahmedabad": ["AHMEDABAD", "ahmedabad"],
}
ORDER_STATUS_SPELLINGS = {
    "Delivered": ["delivered", "DELIVERED"],
    "Shipped": ["shipped", "SHIPPED"],
    "Processing": ["processing", "PROCESSING", "In Process"],
    "Cancelled": ["cancelled", "CANCELLED", "Canceled"],
    "Returned": ["returned", "RETURNED"],
}
CATEGORY_SPELLINGS = {
    "Electronics": ["electronics", "ELECTRONICS"],
    "Fashion": ["fashion", "FASHION"],
    "Furniture": ["furniture", "FURNITURE"],
    "Home Appliances": ["home appliances", "HOME APPLIANCES", "Home-Appliances"],
    "Beauty": ["beauty", "BEAUTY"],
    "Sports": ["sports", "SPORTS"],
    "Books": ["books", "BOOKS"],
}

FAULT_SHARES = {
    "null": 0.05, "duplicate": 0.03, "invalid": 0.02, "spelling": 0.03,
    "outlier": 0.01, "ghost": 0.01, "late": 0.02,
}
BAD_AGES = (-5, 0, 150, 250, 999)
BAD_EMAILS = ("not-an-email", "john.doe@@mail", "missing_at_sign.com", "")
BAD_PHONES = ("123", "abcde12345", "0000000000000")
BAD_ORDER_STATUSES = ("UNKNOWN", "###ERROR###", "N/A", "")
BAD_PAYMENT_STATUSES = ("ERROR", "unknown_status", "")
BAD_DELIVERY_STATUSES = ("LOST_IN_SYSTEM", "???", "")
OUTLIER_DISCOUNTS = (120, 150, 200)

# first order number whose payload carries ``coupon_code``
COUPON_VERSION_START = 10_000

# ---------------------------------------------------------------------------
# Rules of the quality report: (entity, rule, kind, SQL predicate)
# ---------------------------------------------------------------------------

QUALITY_RULES = (
    ("orders", "quantity_negative", "invalid", "quantity < 0"),
    ("orders", "price_negative", "invalid", "price < 0"),
    ("orders", "event_time_in_future", "invalid", "event_time > {now}"),
    ("orders", "amount_above_million", "outlier", "amount > 1000000"),
    ("orders", "quantity_above_100", "outlier", "quantity > 100"),
    ("orders", "discount_above_100", "outlier", "discount > 100"),
    ("customers", "age_out_of_range", "invalid", "age < 0 OR age > 120"),
    ("payments", "amount_negative", "invalid", "amount < 0"),
)
