"""The nine entities of the warehouse: file layout, cleaning rules, merge rules, dimension.

Everything an entity needs to travel stage -> clean -> dimension is declared here; the steps
themselves are in :mod:`plinth.plans.layers`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from plinth.functions import casting as C
from plinth.functions.keys import hash_key
from plinth.operators.enrich import location_columns

Rule = Callable[[], Column]


@dataclass(frozen=True)
class Entity:
    name: str
    stage: list[str]  # columns of the source file, in position order
    clean: dict[str, Rule]  # clean column -> expression over stage columns
    keys: list[str]
    modified: str  # clean column that orders several rows of one key
    update: list[str] | None = None  # columns a merge overwrites; None = all
    only_if_changed: list[str] | None = None
    tracked: list[str] = field(default_factory=list)  # dimension attributes
    hk: str = ""  # dimension hash key column; empty = not a dimension
    hash_cols: list[str] | None = None
    match_on: list[str] = field(default_factory=list)  # columns of the literal merge form
    not_null: list[str] = field(default_factory=list)
    lengths: dict[str, int] = field(default_factory=dict)
    tags: dict[str, str] = field(default_factory=dict)  # clean column -> tag
    must_cast: dict[str, str] = field(default_factory=dict)  # stage text that has to convert
    stage_tags: dict[str, str] = field(default_factory=dict)  # stage column -> tag
    make_key: Callable[..., Column] = hash_key  # ``digest`` for dimensions too large for 60 bits


def text(c: str) -> Rule:
    return lambda: F.col(c)


def trimmed(c: str) -> Rule:
    return lambda: F.trim(c)


def number(c: str) -> Rule:
    return lambda: C.try_number(c)


def amount(c: str, precision: int = 10, scale: int = 2) -> Rule:
    return lambda: C.try_decimal(c, precision, scale)


def day(c: str) -> Rule:
    return lambda: C.try_date(c)


def instant(c: str, fmt: str | None = None) -> Rule:
    return lambda: C.try_timestamp(c, fmt)


def wall_clock(c: str, fmt: str | None = None) -> Rule:
    return lambda: C.try_timestamp(c, fmt).cast("timestamp_ntz")


def derived(c: str) -> Rule:
    return lambda: location_columns("state", "city")[c]


NUMBER = "decimal(38,0)"
DATES = ["createddate", "modifieddate"]

LOCATION = Entity(
    name="location",
    stage=["locationid", "city", "state", "zipcode", "activeflag", *DATES],
    clean={
        "location_id": number("locationid"),
        "city": text("city"),
        **{c: derived(c) for c in (
            "state", "state_code", "is_union_territory", "capital_city_flag", "city_tier")},
        "zip_code": text("zipcode"),
        "active_flag": text("activeflag"),
        "created_ts": instant("createddate", C.TS_SECONDS),
        "modified_ts": instant("modifieddate", C.TS_SECONDS),
    },
    keys=["location_id"],
    modified="modified_ts",
    update=["city", "state", "state_code", "is_union_territory", "capital_city_flag", "city_tier",
            "zip_code", "active_flag", "modified_ts"],
    only_if_changed=["city", "state", "state_code", "is_union_territory", "capital_city_flag",
                     "city_tier", "zip_code", "active_flag", "modified_ts"],
    tracked=["city", "state", "state_code", "is_union_territory", "capital_city_flag", "city_tier",
             "zip_code", "active_flag"],
    hk="restaurant_location_hk",
    hash_cols=["city", "state", "state_code", "zip_code"],
    match_on=["location_id", "active_flag"],
    not_null=["location_id", "city", "state", "state_code", "zip_code", "active_flag", "created_ts"],
    lengths={"city": 100, "state": 100, "state_code": 2, "city_tier": 6, "zip_code": 10,
             "active_flag": 10},
    must_cast={"locationid": NUMBER, "createddate": "timestamp", "modifieddate": "timestamp"},
)

RESTAURANT_TRACKED = [
    "name", "cuisine_type", "pricing_for_two", "restaurant_phone", "operating_hours",
    "location_id_fk", "active_flag", "open_status", "locality", "restaurant_address", "latitude",
    "longitude",
]
RESTAURANT = Entity(
    name="restaurant",
    stage=["restaurantid", "name", "cuisinetype", "pricing_for_2", "restaurant_phone",
           "operatinghours", "locationid", "activeflag", "openstatus", "locality",
           "restaurant_address", "latitude", "longitude", *DATES],
    clean={
        "restaurant_id": number("restaurantid"),
        "name": text("name"),
        "cuisine_type": text("cuisinetype"),
        "pricing_for_two": amount("pricing_for_2"),
        "restaurant_phone": text("restaurant_phone"),
        "operating_hours": text("operatinghours"),
        "location_id_fk": number("locationid"),
        "active_flag": text("activeflag"),
        "open_status": text("openstatus"),
        "locality": text("locality"),
        "restaurant_address": text("restaurant_address"),
        "latitude": amount("latitude", 9, 6),
        "longitude": amount("longitude", 9, 6),
        "created_dt": wall_clock("createddate", C.TS_NANOS),
        "modified_dt": wall_clock("modifieddate", C.TS_NANOS),
    },
    keys=["restaurant_id"],
    modified="modified_dt",
    tracked=RESTAURANT_TRACKED,
    hk="restaurant_hk",
    match_on=["restaurant_id", *RESTAURANT_TRACKED],
    not_null=["restaurant_id", "name"],
    lengths={"name": 100, "restaurant_phone": 15, "operating_hours": 100, "active_flag": 10,
             "open_status": 10, "locality": 100},
    tags={"restaurant_phone": "SENSITIVE"},
    stage_tags={"restaurant_phone": "SENSITIVE"},
    must_cast={"restaurantid": NUMBER},
)

CUSTOMER_TRACKED = [
    "name", "mobile", "email", "login_by_using", "gender", "dob", "anniversary", "preferences",
]
CUSTOMER = Entity(
    name="customer",
    stage=["customerid", "name", "mobile", "email", "loginbyusing", "gender", "dob", "anniversary",
           "preferences", *DATES],
    clean={
        "customer_id": text("customerid"),
        "name": text("name"),
        "mobile": text("mobile"),
        "email": text("email"),
        "login_by_using": text("loginbyusing"),
        "gender": text("gender"),
        "dob": day("dob"),
        "anniversary": day("anniversary"),
        "preferences": text("preferences"),
        "created_dt": instant("createddate", C.TS_ISO),
        "modified_dt": instant("modifieddate", C.TS_ISO),
    },
    keys=["customer_id"],
    modified="modified_dt",
    tracked=CUSTOMER_TRACKED,
    hk="customer_hk",
    match_on=["customer_id", *CUSTOMER_TRACKED],
    not_null=["customer_id", "name"],
    lengths={"name": 100, "mobile": 15, "email": 100, "login_by_using": 50, "gender": 10},
    tags={"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"},
    stage_tags={"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"},
)

ADDRESS_TEXT = [
    "floor", "building", "landmark", "locality", "city", "state", "pincode", "coordinates",
]
ADDRESS_TRACKED = ["customer_id_fk", "flat_no", "house_no", *ADDRESS_TEXT, "primary_flag", "address_type"]
CUSTOMER_ADDRESS = Entity(
    name="customer_address",
    stage=["addressid", "customerid", "flatno", "houseno", *ADDRESS_TEXT, "primaryflag",
           "addresstype", *DATES],
    clean={
        "address_id": number("addressid"),
        "customer_id_fk": number("customerid"),
        "flat_no": text("flatno"),
        "house_no": text("houseno"),
        **{c: text(c) for c in ADDRESS_TEXT},
        "primary_flag": text("primaryflag"),
        "address_type": text("addresstype"),
        "created_date": instant("createddate", C.TS_ISO),
        "modified_date": instant("modifieddate", C.TS_ISO),
    },
    keys=["address_id"],
    modified="modified_date",
    # the owner of an address stays as first loaded
    update=["flat_no", "house_no", *ADDRESS_TEXT, "primary_flag", "address_type", "created_date",
            "modified_date"],
    tracked=ADDRESS_TRACKED,
    hk="customer_address_hk",
    match_on=["address_id", *ADDRESS_TRACKED],
    not_null=["address_id"],
    must_cast={"addressid": NUMBER, "customerid": NUMBER},
)

MENU_TRACKED = [
    "restaurant_id_fk", "item_name", "description", "price", "category", "availability", "item_type",
]
MENU = Entity(
    name="menu",
    stage=["menuid", "restaurantid", "itemname", "description", "price", "category",
           "availability", "itemtype", *DATES],
    clean={
        "menu_id": number("menuid"),
        "restaurant_id_fk": number("restaurantid"),
        "item_name": trimmed("itemname"),
        "description": trimmed("description"),
        "price": amount("price"),
        "category": trimmed("category"),
        "availability": lambda: C.flag("availability"),
        "item_type": trimmed("itemtype"),
        "created_dt": wall_clock("createddate"),
        "modified_dt": wall_clock("modifieddate"),
    },
    keys=["menu_id"],
    modified="modified_dt",
    tracked=MENU_TRACKED,
    hk="menu_dim_hk",
    match_on=["menu_id", *MENU_TRACKED],
    not_null=["menu_id", "item_name", "description", "price"],
    must_cast={"menuid": NUMBER},
)

AGENT_TRACKED = [
    "name", "phone", "vehicle_type", "location_id_fk", "status", "gender", "rating",
]
DELIVERY_AGENT = Entity(
    name="delivery_agent",
    stage=["deliveryagentid", "name", "phone", "vehicletype", "locationid", "status", "gender",
           "rating", *DATES],
    clean={
        "delivery_agent_id": number("deliveryagentid"),
        "name": text("name"),
        "phone": text("phone"),
        "vehicle_type": text("vehicletype"),
        "location_id_fk": number("locationid"),
        "status": text("status"),
        "gender": text("gender"),
        "rating": amount("rating", 4, 2),
        "created_dt": wall_clock("createddate"),
        "modified_dt": wall_clock("modifieddate"),
    },
    keys=["delivery_agent_id"],
    modified="modified_dt",
    # an agent keeps the name of the first load
    update=["phone", "vehicle_type", "location_id_fk", "status", "gender", "rating", "created_dt",
            "modified_dt"],
    tracked=AGENT_TRACKED,
    hk="delivery_agent_hk",
    match_on=["delivery_agent_id", *AGENT_TRACKED],
    not_null=["delivery_agent_id", "name", "phone", "vehicle_type"],
    must_cast={"deliveryagentid": NUMBER},
)

ORDERS = Entity(
    name="orders",
    stage=["orderid", "customerid", "restaurantid", "orderdate", "totalamount", "status",
           "paymentmethod", *DATES],
    clean={
        "order_id": number("orderid"),
        "customer_id_fk": number("customerid"),
        "restaurant_id_fk": number("restaurantid"),
        "order_date": wall_clock("orderdate"),
        "total_amount": amount("totalamount"),
        "status": text("status"),
        "payment_method": text("paymentmethod"),
        "created_dt": instant("createddate"),
        "modified_dt": instant("modifieddate"),
    },
    keys=["order_id"],
    modified="modified_dt",
    update=["total_amount", "status", "payment_method", "modified_dt"],
    must_cast={"orderid": NUMBER},
)

ORDER_ITEM = Entity(
    name="order_item",
    stage=["orderitemid", "orderid", "menuid", "quantity", "price", "subtotal", *DATES],
    clean={
        "order_item_id": number("orderitemid"),
        "order_id_fk": number("orderid"),
        "menu_id_fk": number("menuid"),
        "quantity": amount("quantity"),
        "price": amount("price"),
        "subtotal": amount("subtotal"),
        "created_dt": wall_clock("createddate"),
        "modified_dt": wall_clock("modifieddate"),
    },
    keys=["order_item_id", "order_id_fk", "menu_id_fk"],
    modified="modified_dt",
    not_null=["order_item_id", "order_id_fk", "menu_id_fk"],
    must_cast={
        "orderitemid": NUMBER, "orderid": NUMBER, "menuid": NUMBER, "quantity": "decimal(10,2)",
        "price": "decimal(10,2)", "subtotal": "decimal(10,2)", "createddate": "timestamp",
        "modifieddate": "timestamp",
    },
)

DELIVERY = Entity(
    name="delivery",
    stage=["deliveryid", "orderid", "deliveryagentid", "deliverystatus", "estimatedtime",
           "addressid", "deliverydate", *DATES],
    clean={
        "delivery_id": number("deliveryid"),
        "order_id_fk": number("orderid"),
        "delivery_agent_id_fk": number("deliveryagentid"),
        "delivery_status": text("deliverystatus"),
        "estimated_time": text("estimatedtime"),
        "customer_address_id_fk": number("addressid"),
        "delivery_date": wall_clock("deliverydate"),
        "created_date": wall_clock("createddate"),
        "modified_date": wall_clock("modifieddate"),
    },
    keys=["delivery_id", "order_id_fk", "delivery_agent_id_fk"],
    modified="modified_date",
    not_null=["delivery_id", "order_id_fk", "delivery_agent_id_fk", "customer_address_id_fk"],
    must_cast={
        "deliveryid": NUMBER, "orderid": NUMBER, "deliveryagentid": NUMBER, "addressid": NUMBER,
        "deliverydate": "timestamp", "createddate": "timestamp", "modifieddate": "timestamp",
    },
)

ENTITIES = {
    e.name: e
    for e in (LOCATION, RESTAURANT, CUSTOMER, CUSTOMER_ADDRESS, MENU, DELIVERY_AGENT, ORDERS,
              ORDER_ITEM, DELIVERY)
}
