from settlebook.operators.anti import Facts, KeySet, duplicated_keys, exists_flag, not_in, set_facts  # noqa: F401
from settlebook.operators.conditional import (  # noqa: F401
    Bucket, bucket_sum, combine_bucket_sums, conditional_sums, partial_bucket_sums,
)
from settlebook.operators.latest import latest_as_of, newest  # noqa: F401
from settlebook.operators.merge import full_merge, union_distinct  # noqa: F401
from settlebook.operators.split import not_in_split  # noqa: F401
from settlebook.operators.state import carried_on, fold, merged, unfolded  # noqa: F401
