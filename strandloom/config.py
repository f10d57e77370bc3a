"""Settings of the clustering rounds, with their defaults."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field


#: Fixed value: how files begin the keys of what is called kernel_ here.
FILE_PREFIX = "nspdk_"


@dataclass(frozen=True)
class Config:
    """Fixed values are the known defaults; names are grouped by their prefix."""

    GLOBAL_num_clusters: int = 5
    GLOBAL_iterations: int = 2
    GLOBAL_hit_blacklist_overlap: float = 0.2
    GLOBAL_group_size: int = 100
    kernel_radius: int = 3
    kernel_distance: int = 3
    kernel_excess: int = 5
    kernel_knn_center: int = 20
    kernel_nhf: int = 400
    kernel_nhf_max: int = 1000
    kernel_nhf_step: int = 50
    kernel_fcs: float = 1.0
    kernel_greylist_num: int = 0
    center_subtree_min: int = 3
    center_subtree_max: int = 7
    cm_min_bitscore: float = 20.0
    cm_bitscore_sig: float = 1.0
    cm_max_eval: float = 0.0
    input_dedup_id: float = 90.0
    input_dedup_len: float = 0.9
    input_seq_min_length: int = 30
    input_win_size: int = 150
    input_win_shift: float = 50.0
    input_add_revcompl: int = 0
    results_merge_cluster_ol: float = 0.66
    results_merge_overlap: float = 0.51
    results_top_num: int = 15
    results_min_cluster_size: int = 5
    evaluate: int = 0
    evaluate_min_overlap: float = 0.51
    evaluate_class0_as_fp: int = 1
    extra: dict = field(default_factory=dict)


def parse_config(text: str, force: bool = False) -> tuple[Config, list[str]]:
    """A Config from `key value` lines, and the keys that it doesn't know (kept in extra if force).

    # begins a comment; words behind the second belong to the value; a lone key has an empty value.
    """
    kinds = {f.name: type(f.default) for f in dataclasses.fields(Config) if f.name != "extra"}
    known, extra, odd = {}, {}, []
    for line in text.splitlines():
        words = line.split("#")[0].split()
        if not words:
            continue
        told, value = words[0], " ".join(words[1:])
        key = "kernel_" + told.removeprefix(FILE_PREFIX) if told.startswith(FILE_PREFIX) else told
        if key in kinds:
            known[key] = kinds[key](float(value)) if value and kinds[key] in (int, float) else kinds[key]()
        else:
            odd.append(told)
            if force:
                extra[told] = value
    return Config(**known, extra=extra), odd


def dump_config(config: Config) -> str:
    """Keys grouped by prefix, padded to 30 characters."""
    out, last = [], None
    named = {FILE_PREFIX + k.removeprefix("kernel_") if k.startswith("kernel_") else k: v for k, v in dataclasses.asdict(config).items() if k != "extra"}
    for key, value in sorted(named.items()):
        prefix = key.split("_")[0]
        if last not in (None, prefix):
            out.append("")
        last = prefix
        out.append(f"{key:<30}{value}")
    return "\n".join(out) + "\n"
