from ludomart.operators.dedupe import dedupe_name, dedupe_pk
from ludomart.operators.lookup import lookup
from ludomart.operators.ordering import batch_ids, dense_id, previous_in_order

__all__ = ["batch_ids", "dedupe_name", "dedupe_pk", "dense_id", "lookup", "previous_in_order"]
