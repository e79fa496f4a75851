from screenrank.functions.scalar import (  # noqa: F401
    epoch_seconds, jvm_trim, log10_int, yearmonth, epoch_to_ntz,
)
from screenrank.functions.maps import lookup, recs_to_map  # noqa: F401
from screenrank.functions.vectors import cosine, dot, norm2, try_cosine  # noqa: F401
