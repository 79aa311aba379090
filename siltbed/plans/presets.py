"""Ready-made specs: the order tree, inventory movements and store daily status."""

from __future__ import annotations

from siltbed.spec import RunOptions, Table, Tree

# Table names, link columns, statuses, ages, batch sizes, limits and
# zone that existing installations run with.
ORDER_DEPENDENTS = (
    "cancelled_order_item_history",
    "progress_payment_order",
    "payment",
    "courier_assignment",
    "handling_unit_transaction",
    "waiting_transfer_order",
    "order_addition_history",
    "order_review",
    "order_problem",
    "order_approval",
    "order_history",
    "order_item",
)
ORDER_STATUSES = ("COMPLETED", "CANCELLED", "DELETED")
ORDER_MONTHS = 13
TABLE_MONTHS = 2
ORDER_BATCH = 20
TABLE_BATCH = 300
TIME_LIMIT_SEC = 10_800
ZONE = "Europe/Istanbul"

# The columns the archive tables have. Every table has the audit columns;
# the listed ones come without the flag; links follow from the tree.
AUDIT_COLUMNS = ("id", "created_at", "created_by", "modified_at", "modified_by", "version", "is_deleted")
WITHOUT_ACTIVE = ("progress_payment_order", "order_addition_history", "order_review", "transaction", "store_daily_status")
OWN_COLUMNS = {name: tuple(text.split()) for name, text in {
    "orders": """collector_id courier_id delivery_date delivery_fee external_create_time is_contains_frozen_product
        is_fast_delivery is_payment_success latitude_on_delivery longitude_on_delivery manager_name manager_phone
        non_delivery_note order_note order_number order_type partner payment_id payment_name payment_type price
        refunded_price status time_slot address_id non_delivery_reason_id platform_id slot_id customer_order_number
        delivery_code is_payment_loyalty loyalty_price is_partner_card_payment partner_card_price charge_amount
        is_delivery_from_store cancellation_reason estimated_distance estimated_duration source_id routing_status
        estimated_delivery_time purchase_channel tip_amount external_order_id root_order_number channel
        is_manually_updated air_distance alternative_product_preference invoice_reference_no collection_time
        is_available_for_extra_payment collection_type final_total_price promotion_type planned_delivery_time
        previous_collection_time is_contains_hot_product is_pending_addition is_additional courier_source
        external_reference_id""",
    "cancelled_order_item_history": """product_code product_name erp_code cancellation_reason cancelled_date source
        cancelled_quantity""",
    "progress_payment_order": """progress_payment_id base_amount over_distance_amount over_distance_quantity_in_meter
        over_deci_amount over_deci_quantity special_product_amount special_product_quantity total_amount
        over_weight_amount over_weight_quantity special_day_amount""",
    "payment": "price type refunded_price",
    "courier_assignment": "courier_task_id courier_id vehicle_id route_task_id delivery_sort_number color_id reason_id",
    "handling_unit_transaction": "status handling_unit_id location_id parent_handling_unit_id",
    "waiting_transfer_order": "reason",
    "order_addition_history": "date status",
    "order_review": "question_id answer_id answer_text point",
    "order_problem": "courier_note latitude longitude courier_id order_problem_type_id",
    "order_approval": "approval_time order_approval_status order_approval_reason_id",
    "order_history": """status process_latitude process_longitude distance_to_target_location is_distant_process
        is_manually_updated""",
    "order_item": """barcodes cancellation_reason category category_id discount_price erp_code external_item_id image_url
        is_campaign is_frozen is_refundable name product_code price quantity quantity_type status
        return_on_delivery_reason collected_quantity campaign_name product_price_normal root_external_item_id
        volumetric_weight external_id vat_rate alternative_of_order_item_id weight delivery_condition is_additional
        change_reason_id change_explanation is_change_item_picked_up""",
    "handling_unit_item_transaction": "status handling_unit_transaction_id ordered_quantity collected_quantity",
    "transaction": """current_free_quantity current_quantity inventory_id offer_id owner_id product_id quantity reference_id
        related_transaction_id seller_source shelf_quantity storage_location_id store_id transaction_quantity
        transaction_source type""",
    "store_daily_status": "status date store_id",
}.items()}


def archive_columns(table: str, link: str | None = None) -> tuple[str, ...]:
    """The columns that move, by name: audit, flag, link and the table's own."""
    active = () if table in WITHOUT_ACTIVE else ("is_active",)
    return (*AUDIT_COLUMNS, *active, *((link,) if link else ()), *OWN_COLUMNS[table])


def _table(name: str, parent: str | None = None, link: str | None = None, strict: bool = False, **more) -> Table:
    return Table(name, "id", parent=parent, link=link, columns=archive_columns(name, link) if strict else None, **more)


def order_tree(span: int = 10_000_000, strict: bool = False) -> Tree:
    """Orders with twelve dependents by order and one more by order item.

    ``strict`` moves exactly the archive's columns and fails where a live table lacks one.
    """
    dependents = [_table(name, "orders", "order_id", strict, span=span) for name in ORDER_DEPENDENTS]
    dependents.append(_table("handling_unit_item_transaction", "order_item", "order_item_id", strict, span=span))
    return Tree(_table("orders", strict=strict), tuple(dependents), age_column="delivery_date", months=ORDER_MONTHS,
                status_column="status", statuses=ORDER_STATUSES)


def inventory_movement(strict: bool = False) -> Tree:
    return Tree(_table("transaction", strict=strict), age_column="created_at", months=TABLE_MONTHS)


def store_daily_status(strict: bool = False) -> Tree:
    return Tree(_table("store_daily_status", strict=strict), age_column="date", months=TABLE_MONTHS)


def order_run(parallel: int = 1, **limits) -> RunOptions:
    return RunOptions(parallel=parallel, **{"batch_size": ORDER_BATCH, "time_limit_sec": TIME_LIMIT_SEC, "zone": ZONE, **limits})


def table_run(parallel: int = 1, **limits) -> RunOptions:
    return order_run(parallel, **{"batch_size": TABLE_BATCH, **limits})
