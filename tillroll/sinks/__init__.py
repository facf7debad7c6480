from tillroll.sinks.staging import Written, publish, stage, stage_batch, write_batch
from tillroll.sinks.warehouse import CatalogWarehouse, JdbcWarehouse, PathWarehouse, Warehouse

__all__ = [
    "CatalogWarehouse",
    "JdbcWarehouse",
    "PathWarehouse",
    "Warehouse",
    "Written",
    "publish",
    "stage",
    "stage_batch",
    "write_batch",
]
