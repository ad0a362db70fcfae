"""SQL twins of the registered queries, written against the driver's tables only."""

from oracles import reports, warehouse

SQL: dict[str, str] = {**reports.SQL, **warehouse.SQL}
