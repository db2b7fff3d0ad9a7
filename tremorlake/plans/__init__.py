from .frames import framed, with_halo
from .intervals import asof_join, merge_intervals
from .joins import attach, attach_scalar, join_series
from .positions import running_total, running_totals, with_position
from .quantiles import exact_quantiles
from .scratch import clear_scratch, scratch_scope, write_scratch
from .topk import top_k, top_k_threshold

__all__ = [
    "asof_join",
    "attach",
    "attach_scalar",
    "clear_scratch",
    "exact_quantiles",
    "framed",
    "join_series",
    "merge_intervals",
    "running_total",
    "running_totals",
    "scratch_scope",
    "top_k",
    "top_k_threshold",
    "with_halo",
    "with_position",
    "write_scratch",
]
