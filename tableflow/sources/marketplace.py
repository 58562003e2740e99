"""Contracts of the 14 marketplace tables.

Every table also carries ``record_ts``, the day a row was loaded. Column names, lengths, allowed
values and bounds are fixed values of the data model.
"""

from __future__ import annotations

from tableflow.sources.contracts import (
    DATE, ID, INT, NOW, TIME, TODAY, Column, Contract, decimal, reference, text)

EARLIEST = "2000-01-01"
LEVELS = ("bronze", "silver", "gold")
METHODS = ("Credit Card", "PayPal", "Bank Transfer")


def _table(name, *columns, key=None, identity=None, defaults=None, **rules) -> Contract:
    own_id = (Column(identity, ID),) if identity else ()
    return Contract(
        name=name,
        columns=(*own_id, *columns, Column("record_ts", DATE)),
        primary_key=key or (identity,),
        identity=identity,
        defaults={**(defaults or {}), "record_ts": TODAY},
        **rules)


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(value) for value in values)})"


MARKETPLACE: dict[str, Contract] = {table.name: table for table in (
    _table("users", text("email", 255), text("password_hash", 255), Column("created_at", TIME),
           identity="user_id", uniques=(("email",),), defaults={"created_at": NOW},
           checks={"created_at": f"created_at > TIMESTAMP_NTZ'{EARLIEST}'"}),
    _table("buyers", Column("user_id", ID), Column("loyalty_points", INT, nullable=True),
           text("membership_level", 20),
           identity="buyer_id", uniques=(("user_id",),), defaults={"loyalty_points": 0},
           foreign_keys=(reference("user_id", "users"),),
           checks={"loyalty_points": "loyalty_points >= 0",
                   "membership_level": _one_of("membership_level", LEVELS)}),
    _table("sellers", Column("user_id", ID), text("store_name", 150),
           text("store_description", nullable=True), Column("joined_date", DATE, nullable=True),
           identity="seller_id", uniques=(("user_id",),), defaults={"joined_date": TODAY},
           foreign_keys=(reference("user_id", "users"),),
           checks={"joined_date": f"joined_date > DATE'{EARLIEST}'"}),
    _table("products", Column("seller_id", ID), text("name", 200), Column("price", decimal(10)),
           identity="product_id", uniques=(("seller_id", "name"),),
           foreign_keys=(reference("seller_id", "sellers"),), checks={"price": "price >= 0"}),
    _table("categories", text("name", 100), identity="category_id", uniques=(("name",),)),
    _table("product_categories", Column("product_id", ID), Column("category_id", ID),
           key=("product_id", "category_id"),
           foreign_keys=(reference("product_id", "products"),
                         reference("category_id", "categories"))),
    _table("orders", Column("buyer_id", ID), Column("created_at", TIME),
           Column("total_price", decimal(12)),
           identity="order_id", uniques=(("buyer_id", "created_at"),),
           defaults={"created_at": NOW}, foreign_keys=(reference("buyer_id", "buyers"),),
           checks={"total_price": "total_price >= 0"}),
    _table("order_items", Column("order_id", ID), Column("product_id", ID),
           Column("quantity", INT), Column("price_snapshot", decimal(10)),
           identity="order_item_id", uniques=(("order_id", "product_id"),),
           foreign_keys=(reference("order_id", "orders"), reference("product_id", "products")),
           checks={"quantity": "quantity > 0", "price_snapshot": "price_snapshot >= 0"}),
    _table("payments", Column("order_id", ID), Column("amount", decimal(12)), text("method", 50),
           identity="payment_id", uniques=(("order_id", "method", "amount"),),
           foreign_keys=(reference("order_id", "orders"),),
           checks={"amount": "amount >= 0", "method": _one_of("method", METHODS)}),
    _table("shipments", Column("order_id", ID), text("address"),
           Column("shipped_at", TIME, nullable=True), Column("delivered_at", TIME, nullable=True),
           identity="shipment_id", uniques=(("order_id",),),
           foreign_keys=(reference("order_id", "orders"),)),
    _table("reviews", Column("product_id", ID), Column("buyer_id", ID), Column("rating", INT),
           text("comment", nullable=True), Column("created_at", TIME, nullable=True),
           identity="review_id", uniques=(("product_id", "buyer_id"),),
           defaults={"created_at": NOW},
           foreign_keys=(reference("product_id", "products"), reference("buyer_id", "buyers")),
           checks={"rating": "rating BETWEEN 1 AND 5"}),
    _table("inventory_history", Column("product_id", ID), Column("quantity", INT),
           Column("changed_at", TIME, nullable=True), text("reason", 100),
           identity="inventory_id", uniques=(("product_id", "changed_at", "reason"),),
           defaults={"changed_at": NOW}, foreign_keys=(reference("product_id", "products"),)),
    _table("order_status_history", Column("order_id", ID), text("status", 50),
           Column("changed_at", TIME, nullable=True),
           identity="status_id", uniques=(("order_id", "status", "changed_at"),),
           defaults={"changed_at": NOW}, foreign_keys=(reference("order_id", "orders"),)),
    _table("discounts", Column("product_id", ID), Column("discount_percent", decimal(5)),
           Column("start_date", DATE), Column("end_date", DATE),
           Column("discount_fraction", decimal(5), nullable=True),
           identity="discount_id", uniques=(("product_id", "start_date", "end_date"),),
           foreign_keys=(reference("product_id", "products"),),
           checks={"discount_percent": "discount_percent BETWEEN 0 AND 100",
                   "end_date": "end_date > start_date"},
           computed={"discount_fraction": "discount_percent / 100"}),
)}
