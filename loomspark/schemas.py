"""Tables of the dump model: types, keys, required columns, dump column order and load order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "binary": T.BinaryType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def flat_schema(ddl: str) -> T.StructType:
    """The schema of ``name type, ..``; unlike Spark's own parser it works on executors too."""
    pairs = (c.split() for c in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Table:
    """One table; ``dump`` is the column order in its SQL dump, where it has one."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    loader: str
    dump: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return flat_schema(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _table(name: str, ddl: str, keys: str, required: str, loader: str, dump: str = "") -> Table:
    own = tuple(dump.split()) or (tuple(flat_schema(ddl).names) if loader == "mysqldump" else ())
    return Table(name, ddl, tuple(keys.split()), tuple(required.split()), loader, own)


#: In load order: what others refer to comes first.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        _table(
            "page",
            "page_id bigint, page_namespace int, page_title binary, page_is_redirect boolean, page_is_new boolean, page_random double, page_touched timestamp, page_links_updated timestamp, page_latest bigint, page_len bigint, page_content_model string, page_lang string",
            "page_id",
            "page_id page_namespace page_title page_is_redirect page_is_new page_random page_latest page_len",
            "mysqldump",
        ),
        _table(
            "page_restrictions",
            "pr_id bigint, pr_page bigint, pr_type string, pr_level string, pr_cascade boolean, pr_expiry timestamp",
            "pr_id",
            "pr_id pr_page pr_type pr_level pr_cascade",
            "mysqldump",
            "pr_page pr_type pr_level pr_cascade pr_expiry pr_id",
        ),
        _table(
            "protected_titles",
            "pt_namespace int, pt_title binary, pt_user bigint, pt_reason_id bigint, pt_timestamp timestamp, pt_expiry timestamp, pt_create_perm string",
            "pt_namespace pt_title",
            "pt_namespace pt_title pt_timestamp pt_create_perm",
            "mysqldump",
        ),
        _table("user_groups", "ug_user bigint, ug_group string, ug_expiry timestamp", "ug_user ug_group", "ug_user ug_group", "mysqldump"),
        _table("user_former_groups", "ufg_user bigint, ufg_group string", "ufg_user ufg_group", "ufg_user ufg_group", "mysqldump"),
        _table("change_tag_def", "ctd_id bigint, ctd_name string, ctd_user_defined boolean, ctd_count bigint", "ctd_id", "ctd_id ctd_name ctd_user_defined ctd_count", "mysqldump"),
        _table("change_tag", "ct_id bigint, ct_rc_id bigint, ct_log_id bigint, ct_rev_id bigint, ct_params binary, ct_tag_id bigint", "ct_id", "ct_id ct_tag_id", "mysqldump"),
        _table("actor", "actor_id bigint, actor_user bigint, actor_name binary", "actor_id", "actor_id actor_name", "both XML loaders"),
        _table(
            "logging",
            "log_id bigint, log_type string, log_action string, log_timestamp timestamp, log_actor bigint, log_actor_name binary, log_namespace int, log_title binary, log_page bigint, log_comment string, log_params string, log_deleted int",
            "log_id",
            "log_id log_type log_action log_timestamp log_namespace log_title log_deleted",
            "logging XML",
        ),
        _table(
            "revision",
            "rev_id bigint, rev_page bigint, rev_actor bigint, rev_timestamp timestamp, rev_minor boolean, rev_comment string, rev_sha1 string, rev_len bigint, rev_parent_id bigint",
            "rev_id",
            "rev_id rev_page rev_timestamp rev_minor",
            "stub XML",
        ),
        _table("revision_text", "rev_id bigint, rev_text binary, rev_text_bytes bigint", "rev_id", "rev_id", "history XML"),
    )
}

#: Unique besides the primary key, nulls taken as equal.
UNIQUE = {"actor": ("actor_user", "actor_name"), "change_tag_def": ("ctd_name",)}

#: Namespaces that the legacy talk study keeps.
TALK_NAMESPACES = (1, 3, 5, 7, 9, 11, 13, 15, 101, 119, 711, 829, 2303)

LEGACY = {
    "users": "id int, text string, deleted boolean",
    "pages": "id int, title string, namespace int, restrictions string, deleted boolean",
    "revisions": "id int, timestamp timestamp_ntz, user_id int, page_id int, minor boolean, comment string, text string, bytes int, sha1 string, model string, format string, deleted_text boolean, deleted_comment boolean, deleted_user boolean",
}
