from tillwork.sources.transactions import (
    TRANSACTION_SCHEMA,
    events,
    read_csv_transactions,
    table,
    transactions,
)

__all__ = ["TRANSACTION_SCHEMA", "events", "read_csv_transactions", "table", "transactions"]
