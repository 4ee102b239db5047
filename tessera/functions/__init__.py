from tessera.functions.columns import (  # noqa: F401
    array_md5,
    as_double_array,
    dot,
    glob_to_regex,
    l2_norm,
    matches_any_glob,
    natural_sort_keys,
    seeded_hash,
    sq_norm,
    vscale,
    vsub,
    whitespace_tokens,
)
