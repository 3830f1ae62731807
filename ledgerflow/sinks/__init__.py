from ledgerflow.sinks.writers import (  # noqa: F401
    append,
    cap,
    drop_partitions,
    latest_version,
    list_days,
    list_versions,
    path_exists,
    prune_versions,
    remove_path,
    replace_table,
    spread,
    upsert,
    write_clustered,
    write_mark,
    write_partitioned,
    write_spread,
    write_table,
    write_version,
)
