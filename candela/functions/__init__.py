from candela.functions.columns import (  # noqa: F401
    epoch_to_timestamp, minute_index, null_if_zero, ratio, time_part_map, time_parts, to_price, trading_session,
)
from candela.functions.ids import dense_sequence_id, stable_hash_id  # noqa: F401
