from settlebook.sources.adapters import SettlementInputs, settlement_inputs  # noqa: F401
from settlebook.sources.tables import DRIVER_TABLES, DriverTables  # noqa: F401
from settlebook.sources.warehouse import (  # noqa: F401
    INPUT_TABLES, load_inputs, manual_voids_table, read_table, write_stage,
)
from settlebook.sources.partitions import misplaced, with_day, write_by_day  # noqa: F401
from settlebook.sources.schema import CONTRACT, SchemaError, conform  # noqa: F401
from settlebook.sources.stages import StageStore, input_fingerprint, run_fingerprint  # noqa: F401
