"""DuckDB SQL for the registered queries, written over the relational tables and without JSON.

Where the engine uses another form (intervals, one aggregation, one outer join), the SQL
keeps the plain one: theta joins, EXCEPT ALL, separate inserts and updates."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

_BASE = """
base AS (
  SELECT o_orderkey AS key, o_orderkey + 1 AS issue_id, r_name AS repository_owner, n_name AS repository_name, o_orderstatus AS st, o_orderdate AS d,
         'order ' || o_orderkey AS title0, 'batch-' || (o_orderkey % 12 + 1) AS batch0, c_custkey + 1 AS author_user_id, c_name AS login, c_mktsegment AS user_type
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
obs AS (
  SELECT *, 'run_1' AS run_id, 1 AS version, TIMESTAMP '2001-09-01 22:00:00' AS ingested_at, 'open' AS state, d AS updated_at, CAST(NULL AS TIMESTAMP) AS closed_at,
         true AS labelled, CASE WHEN key % 17 = 0 THEN 'batch-10' ELSE batch0 END AS batch, title0 AS title FROM base WHERE key % 13 <> 0
  UNION ALL
  SELECT *, 'run_1', 1, TIMESTAMP '2001-09-01 22:00:00', 'open', d, NULL, true, 'batch-9', title0 || ' dup' FROM base WHERE key % 13 <> 0 AND key % 17 = 0
  UNION ALL
  SELECT *, 'run_2', 2, TIMESTAMP '2001-09-03 23:50:00', CASE WHEN st = 'F' THEN 'closed' ELSE 'open' END,
         CASE WHEN st = 'F' THEN d + INTERVAL 30 DAY WHEN st = 'O' AND key % 5 = 0 THEN d + INTERVAL 10 DAY ELSE d END,
         CASE WHEN st = 'F' THEN d + INTERVAL 30 DAY END, NOT (st = 'O' AND key % 5 = 0), batch0, title0
  FROM base WHERE st IN ('F', 'P') OR key % 5 = 0 OR key % 13 = 0
  UNION ALL
  SELECT *, 'run_3', 3, TIMESTAMP '2001-09-05 10:00:00', 'open', d + INTERVAL 40 DAY, NULL, true, batch0, title0 || ' edited' FROM base WHERE key % 97 = 0
  UNION ALL
  SELECT *, 'run_4', 4, TIMESTAMP '2001-09-06 10:00:00', 'open', d - INTERVAL 1 DAY, NULL, true, batch0, title0 FROM base WHERE key % 11 = 0),
parts AS (
  SELECT DISTINCT l_orderkey AS key, p_partkey + 1 AS label_id, p_name AS name, lower(substr(md5(p_brand), 1, 6)) AS color, p_type AS description, p_size > 25 AS is_default
  FROM lineitem JOIN part ON l_partkey = p_partkey),
obs_labels AS (SELECT o.*, p.label_id, p.name, p.color, p.description, p.is_default FROM obs o JOIN parts p USING (key) WHERE o.labelled)"""

_NEW = "updated_at DESC, ingested_at DESC, run_id DESC, batch DESC"
_ISSUE = "repository_owner, repository_name, issue_id"
_COLUMNS = "repository_owner, repository_name, issue_id, issue_id AS issue_number, title, state, false AS is_pull_request, author_user_id, d - INTERVAL 2 DAY AS created_at, updated_at, closed_at, run_id AS source_run_id"
_ISSUE_COLUMNS = ["repository_owner", "repository_name", "issue_id", "issue_number", "title", "state", "is_pull_request", "author_user_id", "created_at", "updated_at", "closed_at", "source_run_id"]


def _latest(where: str = "true") -> str:
    return f"SELECT * FROM obs WHERE {where} QUALIFY row_number() OVER (PARTITION BY {_ISSUE} ORDER BY {_NEW}) = 1"


def _issues(where: str = "true") -> str:
    return f"SELECT {_COLUMNS} FROM ({_latest(where)})"


def _relations(where: str = "true") -> str:
    return f"SELECT repository_owner, repository_name, issue_id, p.label_id, updated_at AS observed_at, run_id AS source_run_id FROM ({_latest(where)}) x JOIN parts p USING (key) WHERE labelled"


def _label_state(where: str = "true") -> str:
    return f"""SELECT repository_owner, repository_name, label_id, name, color, description, is_default, updated_at AS observed_at, run_id AS source_run_id FROM obs_labels WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY repository_owner, repository_name, label_id ORDER BY {_NEW}) = 1"""


def _user_state(where: str = "true") -> str:
    return f"SELECT author_user_id AS user_id, login, user_type, updated_at AS observed_at, run_id AS source_run_id FROM obs WHERE {where} QUALIFY row_number() OVER (PARTITION BY author_user_id ORDER BY {_NEW}) = 1"


def _upsert(target: str, source: str, keys: list[str], columns: list[str], order: str) -> str:
    """Insert what is new, update what is not older, keep the rest, as three SELECTs."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    t, s = (", ".join(f"{x}.{c}" for c in columns) for x in "ts")
    return f"""SELECT {s} FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})
  UNION ALL SELECT {s} FROM {source} s JOIN {target} t ON {on} WHERE s.{order} >= t.{order}
  UNION ALL SELECT {t} FROM {target} t LEFT JOIN {source} s ON {on} WHERE s.{keys[0]} IS NULL OR s.{order} < t.{order}"""


def _changes(target: str, source: str, keys: list[str], columns: list[str], order: str, version: int) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    t, s = (", ".join(f"{x}.{c}" for c in columns) for x in "ts")
    return f"""SELECT {s}, 'insert' AS _change_type, {version} AS _commit_version FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})
  UNION ALL SELECT {t}, 'update_preimage', {version} FROM {target} t JOIN {source} s ON {on} WHERE s.{order} >= t.{order}
  UNION ALL SELECT {s}, 'update_postimage', {version} FROM {target} t JOIN {source} s ON {on} WHERE s.{order} >= t.{order}"""


_REL = ["repository_owner", "repository_name", "issue_id", "label_id", "observed_at", "source_run_id"]
_RKEY, _IKEY = _REL[:4], _REL[:3]
_RON = "t.repository_owner = s.repository_owner AND t.repository_name = s.repository_name AND t.issue_id = s.issue_id AND t.label_id = s.label_id"


def _gone(target: str, source: str, scope: str) -> str:
    return f"""SELECT t.* FROM {target} t JOIN {scope} c ON t.repository_owner = c.repository_owner AND t.repository_name = c.repository_name AND t.issue_id = c.issue_id
  WHERE t.observed_at <= c.updated_at AND NOT EXISTS (SELECT 1 FROM {source} s WHERE {_RON})"""


def _reconciled(target: str, source: str, scope: str) -> str:
    return f"SELECT * FROM ({_upsert(target, source, _RKEY, _REL, 'observed_at')}) EXCEPT ALL ({_gone(target, source, scope)})"


def _sql(name: str, body: str, *ctes: str, base: bool = True) -> None:
    parts = [*([_BASE.strip()] if base else []), *ctes]
    ORACLE_SQL[name] = (f"WITH {', '.join(parts)} " if parts else "") + body


def _states() -> list[str]:
    """CTEs of the states after each run and of both change logs."""
    out = [f"i1 AS ({_issues("run_id = 'run_1'")})", f"r1 AS ({_relations("run_id = 'run_1'")})"]
    for v in (2, 3, 4):
        where = f"run_id = 'run_{v}'"
        out += [f"si{v} AS ({_issues(where)})", f"sc{v} AS ({_latest(where)})", f"sr{v} AS ({_relations(where)})"]
        out += [f"i{v} AS ({_upsert(f'i{v - 1}', f'si{v}', _IKEY, _ISSUE_COLUMNS, 'updated_at')})", f"r{v} AS ({_reconciled(f'r{v - 1}', f'sr{v}', f'sc{v}')})"]
        out += [f"ci{v} AS ({_changes(f'i{v - 1}', f'si{v}', _IKEY, _ISSUE_COLUMNS, 'updated_at', v)})"]
        out += [f"cr{v} AS ({_changes(f'r{v - 1}', f'sr{v}', _RKEY, _REL, 'observed_at', v)} UNION ALL SELECT g.*, 'delete', {v} FROM ({_gone(f'r{v - 1}', f'sr{v}', f'sc{v}')}) g)"]
    out.append("ci AS (SELECT * FROM ci2 UNION ALL SELECT * FROM ci3 UNION ALL SELECT * FROM ci4)")
    out.append("cr AS (SELECT * FROM cr2 UNION ALL SELECT * FROM cr3 UNION ALL SELECT * FROM cr4)")
    business = [c for c in _ISSUE_COLUMNS if c not in (*_IKEY, "source_run_id")]
    moved = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in business)
    out.append(
        f"""real_i AS (SELECT {_ISSUE}, _commit_version, _change_type AS change FROM ci WHERE _change_type IN ('insert', 'delete')
  UNION ALL SELECT b.repository_owner, b.repository_name, b.issue_id, b._commit_version, 'update' FROM ci b JOIN ci a USING ({_ISSUE}, _commit_version)
  WHERE b._change_type = 'update_preimage' AND a._change_type = 'update_postimage' AND ({moved}))"""
    )
    out.append(f"real_r AS (SELECT {', '.join(_RKEY)}, _commit_version, _change_type AS change FROM cr WHERE _change_type IN ('insert', 'delete'))")
    out.append(f"work AS (SELECT DISTINCT {_ISSUE} FROM (SELECT {_ISSUE} FROM real_i UNION ALL SELECT {_ISSUE} FROM real_r))")
    return out


_IK = "sha256(repository_owner || '||' || repository_name || '||' || issue_id)"
_RK = "sha256(repository_owner || '||' || repository_name)"
_LK = "sha256(repository_owner || '||' || repository_name || '||' || label_id)"


def _fact(source: str) -> str:
    return f"""SELECT {_IK} AS issue_key, {_RK} AS repository_key, sha256(CAST(author_user_id AS VARCHAR)) AS author_key, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_key,
  CAST(strftime(updated_at, '%Y%m%d') AS INTEGER) AS updated_date_key, CAST(strftime(closed_at, '%Y%m%d') AS INTEGER) AS closed_date_key, * FROM ({source})"""


def _bridge(source: str) -> str:
    return f"SELECT {_IK} AS issue_key, {_LK} AS label_key, repository_owner, repository_name, issue_id, label_id FROM ({source})"


_sql("observe_payloads", "SELECT repository_owner, repository_name, issue_id, updated_at AS source_updated_at, run_id AS _run_id, ingested_at AS _ingested_at, batch AS _page_or_batch_reference FROM obs")
_sql("observation_log", "SELECT CAST(version AS BIGINT) AS _commit_version, run_id AS _run_id, count(*) AS n_rows, count(DISTINCT issue_id) AS n_issues FROM obs GROUP BY ALL")
_sql(
    "schema_contract",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({e}) AS nulls FROM obs"
        for c, e in [("repository_owner",) * 2, ("repository_name",) * 2, ("issue_id",) * 2, ("source_updated_at", "updated_at"), ("raw_json", "title"), ("_run_id", "run_id"), ("_ingested_at", "ingested_at"), ("_page_or_batch_reference", "batch")]
    ),
)
_sql("incremental_extract", "SELECT issue_id, run_id AS _run_id, batch AS _page_or_batch_reference, updated_at AS source_updated_at FROM obs WHERE updated_at >= TIMESTAMP '2001-07-01 00:05:00' - INTERVAL 300 SECOND")
_sql("candidate_watermark", "SELECT greatest(max(updated_at), TIMESTAMP '2001-01-01 00:00:00') AS candidate, count(*) AS rows_read FROM obs WHERE run_id = 'run_2'")
_sql(
    "ingest_batches",
    """SELECT run_id AS _run_id, 'batch-' || ((rn - 1) // 100 + 1) AS batch, count(*) AS n_rows, min(issue_id) AS first_issue
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY issue_id, batch) AS rn FROM obs) GROUP BY 1, 2""",
)
_sql("scoped_run_latest", f"SELECT repository_owner, repository_name, issue_id, title, state, updated_at FROM ({_latest("run_id = 'run_1'")})")

_sql("parse_issues", f"SELECT {_COLUMNS}, batch AS _page_or_batch_reference FROM obs")
_sql("pull_request_flag", "SELECT o_orderkey + 1 AS issue_id, o_orderkey % 3 = 0 AS is_pull_request FROM orders", base=False)
_sql("canonical_payloads", "SELECT o_orderkey, '{\"id\":' || o_orderkey || ',\"labels\":[{\"a\":[],\"b\":1}],\"pull_request\":{\"n\":null,\"url\":\"u\"},\"state\":null,\"title\":\"t\"}' AS canonical, true AS same FROM orders", base=False)
_sql("latest_issue", _issues())
_sql("latest_label", f"SELECT * EXCLUDE (source_run_id) FROM ({_label_state()})")
_sql("latest_user", f"SELECT * EXCLUDE (source_run_id) FROM ({_user_state()})")
_sql("observed_scope", f"SELECT repository_owner, repository_name, issue_id, updated_at AS observed_at, run_id AS source_run_id, CASE WHEN labelled THEN (SELECT count(*) FROM parts p WHERE p.key = x.key) ELSE 0 END AS n_labels FROM ({_latest()}) x")
_sql("current_relations", _relations())
_sql("label_observations", "SELECT repository_owner, repository_name, issue_id AS source_issue_id, label_id, name, color, is_default, run_id AS source_run_id, batch AS _page_or_batch_reference FROM obs_labels")

_BAD = "key % 101 = 0"
_sql(
    "invalid_observations",
    f"""SELECT issue_id, run_id AS source_run_id, batch AS _page_or_batch_reference,
  CASE key % 3 WHEN 0 THEN 'title blank' WHEN 1 THEN '_created_raw without zone; created_at missing' ELSE 'author_user_id not positive' END AS violations FROM obs WHERE {_BAD}""",
)
_sql(
    "invalid_label_envelopes",
    f"""SELECT issue_id, run_id AS source_run_id, batch AS _page_or_batch_reference, CASE key % 4 WHEN 0 THEN 'labels missing' ELSE 'labels repeat an id' END AS violations FROM obs
  WHERE {_BAD} AND (key % 4 = 0 OR (key % 4 = 1 AND labelled AND EXISTS (SELECT 1 FROM parts p WHERE p.key = obs.key)))""",
)
_sql("invalid_labels", f"SELECT issue_id AS source_issue_id, label_id, run_id AS source_run_id, batch AS _page_or_batch_reference, 'color not six hex digits' AS violations FROM obs_labels WHERE {_BAD} AND key % 4 = 2")
_sql(
    "invalid_users",
    f"""SELECT issue_id AS source_issue_id, run_id AS source_run_id, batch AS _page_or_batch_reference, CASE key % 3 WHEN 0 THEN 'login blank' ELSE 'user_id not positive; login blank; user_type blank' END AS violations
  FROM obs WHERE {_BAD} AND key % 3 IN (0, 2)""",
)
_sql("duplicate_keys", f"SELECT {_ISSUE}, run_id AS _run_id, count(*) AS n FROM obs GROUP BY ALL HAVING count(*) > 1")
_sql(
    "orphan_relations",
    f"""SELECT r.repository_owner, r.repository_name, r.issue_id, r.label_id, r.source_run_id FROM ({_relations()}) r LEFT JOIN ({_latest("run_id = 'run_1'")}) c USING (repository_owner, repository_name, issue_id)
  WHERE c.key IS NULL OR c.updated_at <> r.observed_at OR c.run_id <> r.source_run_id""",
)

_LCOL = ["repository_owner", "repository_name", "label_id", "name", "color", "description", "is_default", "observed_at", "source_run_id"]
_UCOL = ["user_id", "login", "user_type", "observed_at", "source_run_id"]
_sql("upsert_latest", _upsert("t0", "s0", _IKEY, _ISSUE_COLUMNS, "updated_at"), f"t0 AS ({_issues("run_id = 'run_1'")})", f"s0 AS ({_issues("run_id = 'run_2'")})")
_sql("upsert_labels", _upsert("t0", "s0", _LCOL[:3], _LCOL, "observed_at"), f"t0 AS ({_label_state("run_id = 'run_2'")})", f"s0 AS ({_label_state("run_id = 'run_4'")})")
_sql("upsert_users", _upsert("t0", "s0", _UCOL[:1], _UCOL, "observed_at"), f"t0 AS ({_user_state("run_id = 'run_2'")})", f"s0 AS ({_user_state("run_id = 'run_4'")})")
_PAIR = [f"t0 AS ({_relations("run_id = 'run_1'")})", f"s0 AS ({_relations("run_id = 'run_2'")})", f"c0 AS ({_latest("run_id = 'run_2'")})"]
_sql("reconcile_relations", _reconciled("t0", "s0", "c0"), *_PAIR)
_sql(
    "reconcile_with_parents",
    _reconciled("t0", "s0", "c0"),
    f"t0 AS ({_relations("run_id = 'run_2'")})",
    f"p0 AS ({_latest("run_id = 'run_2'")})",
    f"c0 AS (SELECT c.* FROM ({_latest("run_id = 'run_4'")}) c LEFT JOIN p0 p USING (repository_owner, repository_name, issue_id) WHERE p.key IS NULL OR c.updated_at >= p.updated_at)",
    "s0 AS (SELECT repository_owner, repository_name, issue_id, p.label_id, updated_at AS observed_at, run_id AS source_run_id FROM c0 JOIN parts p USING (key) WHERE labelled)",
)
_sql("stale_relations", f"SELECT {', '.join(_RKEY)} FROM ({_gone('t0', 's0', 'c0')})", *_PAIR)
_sql("replay_equals_merge", "SELECT * FROM (VALUES ('issues', CAST(0 AS BIGINT)), ('labels', 0), ('users', 0)) v(table_name, differences)", base=False)
_sql(
    "merge_change_log",
    f"SELECT issue_id, title, state, updated_at, source_run_id, _change_type, CAST(_commit_version AS BIGINT) AS _commit_version, TIMESTAMP '2001-09-03 23:50:00' AS _commit_timestamp FROM ({_changes('t0', 's0', _IKEY, _ISSUE_COLUMNS, 'updated_at', 2)})",
    f"t0 AS ({_issues("run_id = 'run_1'")})",
    f"s0 AS ({_issues("run_id = 'run_2'")})",
)

_GOOD = "run_id IN ('run_1', 'run_2', 'run_4')"
_MAN = "man AS (SELECT 'manifest-' || n_nationkey AS manifest_id, r_name AS repository_owner, n_name AS repository_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
_sql("as_of_version", "SELECT issue_id, run_id AS _run_id, CAST(version AS BIGINT) AS _commit_version, batch AS _page_or_batch_reference FROM obs WHERE version <= 2")
_sql("frozen_input", f"SELECT manifest_id, run_id AS _run_id, count(*) AS n_rows, CAST(sum(issue_id) AS BIGINT) AS sum_ids FROM obs JOIN man USING (repository_owner, repository_name) WHERE {_GOOD} GROUP BY ALL", _MAN)
_sql(
    "frozen_input_missing_runs",
    """SELECT m.manifest_id, w.run_id FROM man m, LATERAL (SELECT unnest(['run_1', 'run_2', 'run_4', 'run_of_' || m.repository_name]) AS run_id) w
  WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.repository_owner = m.repository_owner AND o.repository_name = m.repository_name AND o.run_id = w.run_id)""",
    _MAN,
)
_sql("resolve_version", "SELECT CAST(max(version) AS BIGINT) AS version FROM obs WHERE ingested_at <= TIMESTAMP '2001-09-03 23:50:00'")
_sql(
    "freeze_counts",
    f"""SELECT 'issues' AS table_name, count(*) AS n_rows FROM ({_issues(_GOOD)}) UNION ALL SELECT 'users', count(*) FROM ({_user_state(_GOOD)})
  UNION ALL SELECT 'labels', count(*) FROM ({_label_state(_GOOD)}) UNION ALL SELECT 'relations', count(*) FROM ({_relations(_GOOD)})""",
)
_sql("replay_issues", f"SELECT *, 'm' AS manifest_id, 'x' AS replay_execution_id FROM ({_issues(_GOOD)})")
_sql("replay_relations", f"SELECT *, 'm' AS manifest_id, 'x' AS replay_execution_id FROM ({_relations(_GOOD)})")


def _report(name: str, left: str, right: str) -> str:
    a, b = f"SELECT * EXCLUDE (source_run_id) FROM ({left})", f"SELECT * EXCLUDE (source_run_id) FROM ({right})"
    return f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM ({a})) AS left_rows, (SELECT count(*) FROM ({b})) AS right_rows,
  (SELECT count(*) FROM ({a} EXCEPT ALL {b})) AS left_only, (SELECT count(*) FROM ({b} EXCEPT ALL {a})) AS right_only"""


_sql("replay_report", " UNION ALL ".join(_report(name, make(_GOOD), make()) for name, make in (("issues", _issues), ("labels", _label_state), ("relations", _relations), ("users", _user_state))))
_sql("replay_labels", f"SELECT *, 'm' AS manifest_id, 'x' AS replay_execution_id FROM ({_label_state(_GOOD)})")
_sql("replay_users", f"SELECT *, 'm' AS manifest_id, 'x' AS replay_execution_id FROM ({_user_state(_GOOD)})")
_READABLE = "(SELECT count(DISTINCT run_id) FROM obs WHERE obs.repository_owner = man.repository_owner AND obs.repository_name = man.repository_name AND run_id IN ('run_1', 'run_2', 'run_4')) = 3"
_TOLD = " || ".join(f"octet_length(encode({c})) || ':' || {c}" for c in ("repository_owner", "repository_name"))
_BUILT = f"""SELECT 'manifest-' || substr(sha256({_TOLD} || '12:observations1:43;5:run_15:run_25:run_4' || '15:' || epoch_us(TIMESTAMP '2001-09-07 00:00:00') || '6:abc1231:1'), 1, 16) AS manifest_id,
  repository_owner, repository_name, CAST(4 AS BIGINT) AS bronze_version, 'run_1,run_2,run_4' AS run_ids, TIMESTAMP '2001-09-07 00:00:00' AS cutoff_at FROM man WHERE {_READABLE}"""
_sql("build_manifest", _BUILT, _MAN)
_sql("stored_manifests", f"SELECT *, CAST(0 AS BIGINT) AS inserted_again FROM ({_BUILT})", _MAN)
_sql(
    "unreadable_runs",
    """SELECT repository_owner, repository_name, run_id FROM man, unnest(['run_1', 'run_2', 'run_4', 'run_of_' || repository_name]) AS u(run_id)
  WHERE NOT EXISTS (SELECT 1 FROM obs WHERE obs.repository_owner = man.repository_owner AND obs.repository_name = man.repository_name AND obs.run_id = u.run_id)""",
    _MAN,
)
_sql(
    "ineligible_runs",
    """SELECT run_id, CASE run_id WHEN 'run_3' THEN 'not succeeded' ELSE 'finished after the cutoff' END AS reason FROM (SELECT DISTINCT run_id FROM obs) WHERE run_id IN ('run_3', 'run_4')
  UNION ALL SELECT r_name, 'unknown' FROM region""",
)
_sql("manifest_conflicts", "SELECT manifest_id, 'other' AS code_commit FROM man WHERE length(repository_name) = 8", _MAN)

_S = _states()
_sql("pinned_state", "SELECT * FROM i2", *_S)
_sql("latest_issue_of_run", f"SELECT * FROM ({_issues()}) WHERE issue_id IN (SELECT issue_id FROM obs WHERE run_id = 'run_4')")
_sql("change_feed_range", "SELECT CAST(_commit_version AS BIGINT) AS _commit_version, _change_type, count(*) AS n_rows FROM ci WHERE _commit_version BETWEEN 3 AND 4 GROUP BY ALL", *_S)
_sql("real_changes", f"SELECT {_ISSUE}, CAST(_commit_version AS BIGINT) AS _commit_version, change FROM real_i", *_S)
_sql("real_relation_changes", f"SELECT {', '.join(_RKEY)}, CAST(_commit_version AS BIGINT) AS _commit_version, change FROM real_r", *_S)
_sql("changed_keys", "SELECT * FROM work", *_S)
_sql(
    "plan_ranges",
    """SELECT source_table, CASE WHEN k % 4 <> 3 THEN CASE WHEN k % 8 = 0 THEN n + 1 ELSE n - 2 END END AS start_version, n AS end_version,
  CASE WHEN k % 4 = 2 THEN 'two starts' WHEN k % 4 = 3 THEN 'no start' WHEN k % 8 = 0 THEN 'idle' ELSE 'ready' END AS status
  FROM (SELECT 't' || c_nationkey AS source_table, c_nationkey AS k, count(*) AS n FROM customer GROUP BY c_nationkey)""",
    base=False,
)
_sql("workset_filter", f"SELECT issue_id, title, state FROM i4 SEMI JOIN work USING ({_ISSUE})", *_S)
_sql("published_fact", f"SELECT * EXCLUDE (source_run_id) FROM ({_fact('SELECT * FROM i4')})", *_S)
_sql("fact_issue_incremental", f"SELECT * EXCLUDE (source_run_id) FROM ({_fact('SELECT * FROM i4')})", *_S)
_sql("bridge_incremental", _bridge("SELECT * FROM r4"), *_S)
_sql(
    "incremental_batch",
    """SELECT 'workset' AS table_name, count(*) AS n_rows FROM work UNION ALL SELECT 'fact_differences', 0 UNION ALL SELECT 'bridge_differences', 0
  UNION ALL SELECT 'fact', count(*) FROM i4 UNION ALL SELECT 'bridge', count(*) FROM r4""",
    *_S,
)
_sql(
    "diff_both_ways",
    """SELECT issue_id, title, state, 'left' AS side, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL
  UNION ALL SELECT issue_id, title, state, 'right', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL""",
    f"a AS (SELECT issue_id, title, state FROM ({_latest("run_id = 'run_1'")}))",
    f"b AS (SELECT issue_id, title, state FROM ({_latest("run_id = 'run_2'")}))",
)
_sql("lineage_differences", f"SELECT a.run_id AS left_run, b.run_id AS right_run, count(*) AS n FROM ({_latest(_GOOD)}) a JOIN ({_latest()}) b USING (repository_owner, repository_name, issue_id) WHERE a.run_id <> b.run_id GROUP BY ALL")
_sql("unexplained_differences", f"SELECT a.run_id AS left_run, b.run_id AS right_run, count(*) AS n FROM ({_latest("run_id = 'run_1'")}) a JOIN ({_latest()}) b USING (repository_owner, repository_name, issue_id) WHERE a.run_id <> b.run_id AND b.run_id <> 'run_3' GROUP BY ALL")

_CAL = """CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, CAST(day AS DATE) AS calendar_date, CAST(year(day) AS INTEGER) AS calendar_year, CAST(quarter(day) AS INTEGER) AS calendar_quarter, CAST(month(day) AS INTEGER) AS month_number,
  monthname(day) AS month_name, CAST(day(day) AS INTEGER) AS day_of_month, CAST(isodow(day) AS INTEGER) AS iso_day_of_week_number, dayname(day) AS day_name, isodow(day) >= 6 AS is_weekend"""
_sql("fact_issue", _fact(_issues()))
_sql("dim_repository", f"SELECT {_RK} AS repository_key, repository_owner, repository_name FROM (SELECT DISTINCT repository_owner, repository_name FROM obs)")
_sql("dim_user", f"SELECT sha256(CAST(user_id AS VARCHAR)) AS user_key, user_id, login, user_type FROM ({_user_state()})")
_sql("dim_label", f"SELECT {_LK} AS label_key, repository_owner, repository_name, label_id, name, color, description, is_default FROM ({_label_state()})")
_sql("dim_date", f"SELECT {_CAL.replace('day(day)', 'dayofmonth(day)')} FROM (SELECT DISTINCT CAST(d - INTERVAL 2 DAY AS DATE) AS day FROM base)")
_sql("bridge_issue_label", _bridge(_relations()))
_sql("open_backlog", f"SELECT repository_owner, repository_name, count(*) AS open_issues FROM ({_latest()}) WHERE state = 'open' GROUP BY ALL")
_sql("top_authors", f"SELECT author_user_id AS user_id, login, count(*) AS issues FROM ({_latest()}) GROUP BY ALL ORDER BY issues DESC, user_id LIMIT 10")
_sql("issues_per_label", f"SELECT repository_owner, repository_name, label_id, name, count(*) AS issues FROM ({_relations()}) JOIN (SELECT DISTINCT label_id, name FROM parts) USING (label_id) GROUP BY ALL")
_sql("issues_per_month", f"SELECT CAST(year(d - INTERVAL 2 DAY) AS INTEGER) AS calendar_year, CAST(month(d - INTERVAL 2 DAY) AS INTEGER) AS month_number, count(*) AS issues FROM ({_latest()}) GROUP BY ALL")
_sql(
    "gate_report",
    """SELECT 'fact_issue' AS table_name, 'not_null' AS gate, 'issue_key' AS subject, CAST(0 AS BIGINT) AS failures UNION ALL SELECT 'fact_issue', 'not_null', 'author_key', 0
  UNION ALL SELECT 'fact_issue', 'not_null', 'closed_date_key', count(*) FILTER (closed_at IS NULL) FROM l UNION ALL SELECT 'fact_issue', 'accepted_values', 'state', count(*) FILTER (state <> 'open') FROM l
  UNION ALL SELECT 'fact_issue', 'unique', 'issue_key', 0 UNION ALL SELECT 'fact_issue', 'unique', 'author_key,created_date_key', count(*) FROM (SELECT 1 FROM l GROUP BY author_user_id, CAST(d AS DATE) HAVING count(*) > 1)""",
    f"l AS ({_latest()})",
)
_sql("orphan_foreign_keys", "SELECT DISTINCT sha256(CAST(author_user_id AS VARCHAR)) AS author_key FROM obs WHERE author_user_id % 7 = 0")

_FIN = "fin AS (SELECT * FROM (VALUES ('run_1', TIMESTAMP '2001-09-01 23:00:00'), ('run_2', TIMESTAMP '2001-09-04 00:10:00'), ('run_4', TIMESTAMP '2001-09-06 11:00:00')) v(run_id, finished_at))"
_sql("manifest_runs", "SELECT manifest_id, run_id, finished_at FROM man CROSS JOIN fin", _MAN, _FIN)
_sql("manifest_observations", f"SELECT repository_name, run_id AS source_run_id, state, count(*) AS n_rows, max(updated_at) AS newest FROM obs WHERE {_GOOD} GROUP BY ALL")
_DAYS = "days AS (SELECT CAST(unnest(generate_series(DATE '2001-08-31', DATE '2001-09-07', INTERVAL 1 DAY)) AS DATE) AS snapshot_date)"
_sql("day_coverage", "SELECT snapshot_date, CASE WHEN EXISTS (SELECT 1 FROM fin WHERE CAST(finished_at AS DATE) = snapshot_date) THEN 'observed' ELSE 'missing' END AS coverage FROM days", _FIN, _DAYS, base=False)
_PICK = f"""pick AS (SELECT * FROM (SELECT DISTINCT CAST(finished_at AS DATE) AS snapshot_date FROM fin) c JOIN obs ON ingested_at < c.snapshot_date + INTERVAL 1 DAY WHERE {_GOOD}
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, {_ISSUE} ORDER BY ingested_at DESC, updated_at DESC, run_id DESC, batch DESC) = 1)"""
_sql(
    "daily_snapshot",
    f"""SELECT {_IK} AS issue_key, {_RK} AS repository_key, snapshot_date, repository_owner, repository_name, issue_id, state, state = 'open' AS is_open_on_date,
  CAST(date_diff('day', CAST(d - INTERVAL 2 DAY AS DATE), snapshot_date) AS INTEGER) AS age_days, run_id AS observation_run_id, ingested_at AS observed_at FROM pick""",
    _FIN,
    _PICK,
)
_sql("daily_snapshot_labels", f"SELECT {_IK} AS issue_key, {_LK} AS label_key, snapshot_date, repository_owner, repository_name, issue_id, label_id FROM pick JOIN parts USING (key) WHERE labelled", _FIN, _PICK)
_sql(
    "daily_snapshot_events",
    """SELECT snapshot_date, user_id + 1 AS entity_id, event_type AS state, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS snapshot_date FROM events WHERE event_type = 'signup') c JOIN events e ON e.ts < c.snapshot_date + INTERVAL 1 DAY
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, user_id ORDER BY ts DESC, event_id DESC) = 1""",
    base=False,
)
_sql("backlog_by_day", "SELECT snapshot_date, count(*) FILTER (state = 'open') AS open_issues, count(*) AS known_issues FROM pick GROUP BY ALL", _FIN, _PICK)

_LEDGER = """led AS (SELECT v.run_id, v.status, v.started_at, v.finished_at, CASE WHEN v.run_id <> 'run_5' THEN (SELECT max(updated_at) FROM obs o WHERE o.run_id = v.run_id) END AS candidate_watermark_value, v.error_message
  FROM (VALUES ('run_1', 'succeeded', TIMESTAMP '2001-09-01 22:00:00', TIMESTAMP '2001-09-01 23:00:00', CAST(NULL AS VARCHAR)), ('run_2', 'succeeded', TIMESTAMP '2001-09-03 23:50:00', TIMESTAMP '2001-09-04 00:10:00', NULL),
  ('run_3', 'failed', TIMESTAMP '2001-09-05 10:00:00', TIMESTAMP '2001-09-05 10:05:00', 'boom'), ('run_4', 'succeeded', TIMESTAMP '2001-09-06 10:00:00', TIMESTAMP '2001-09-06 11:00:00', NULL),
  ('run_5', 'running', TIMESTAMP '2001-09-07 10:00:00', NULL, NULL)) v(run_id, status, started_at, finished_at, error_message))"""
_STORED = "stored AS (SELECT r_name AS source_name, 'issues' AS entity_name, 'updated_at' AS watermark_column, TIMESTAMP '2001-08-10 00:00:00' AS watermark_value, CAST(300 AS BIGINT) AS overlap_seconds, 'run_0' AS last_successful_run_id, TIMESTAMP '2001-08-10 00:00:00' AS updated_at FROM region)"
_sql("run_ledger", "SELECT * FROM led", _LEDGER)
_sql(
    "invalid_runs",
    """SELECT run_id, concat_ws('; ', CASE WHEN run_id = 'run_3' THEN 'failed without a message' END, CASE WHEN run_id = 'run_1' THEN 'message without a failure' END,
  CASE WHEN candidate_watermark_value < TIMESTAMP '2001-08-15 00:00:00' THEN 'candidate before its watermark' END) AS violations FROM led
  WHERE run_id IN ('run_1', 'run_3') OR candidate_watermark_value < TIMESTAMP '2001-08-15 00:00:00'""",
    _LEDGER,
)
_sql(
    "commit_watermark",
    """SELECT s.source_name, s.entity_name, s.watermark_column, coalesce(n.candidate_watermark_value, s.watermark_value) AS watermark_value, s.overlap_seconds, coalesce(n.run_id, s.last_successful_run_id) AS last_successful_run_id,
  coalesce(n.finished_at, s.updated_at) AS updated_at FROM stored s LEFT JOIN new n ON n.source_name = s.source_name AND n.candidate_watermark_value >= s.watermark_value""",
    _LEDGER,
    _STORED,
    """new AS ((SELECT 'ASIA' AS source_name, * FROM led WHERE status = 'succeeded' ORDER BY candidate_watermark_value DESC, finished_at DESC, run_id DESC LIMIT 1)
  UNION ALL SELECT 'EUROPE', * FROM led WHERE run_id = 'run_4')""",
)
_sql(
    "commit_positions",
    """SELECT 'model' AS consumer_name, n_name AS source_table, CAST(CASE WHEN n_nationkey >= 20 THEN n_nationkey WHEN n_nationkey < 5 THEN 10 ELSE greatest(10, n_nationkey) END AS BIGINT) AS last_version,
  CASE WHEN n_nationkey < 10 THEN 'run_1' ELSE 'run_4' END AS last_run_id, TIMESTAMP '2001-09-06 11:00:00' AS updated_at FROM nation""",
    base=False,
)
_sql(
    "pipeline_health",
    """SELECT 'pipeline_run' AS record_type, 1 AS record_type_order, run_id, status, started_at, finished_at, candidate_watermark_value, error_message, CAST(NULL AS VARCHAR) AS source_name, CAST(NULL AS VARCHAR) AS entity_name,
  CAST(NULL AS VARCHAR) AS watermark_column, CAST(NULL AS TIMESTAMP) AS committed_watermark_value, CAST(NULL AS BIGINT) AS overlap_seconds, CAST(NULL AS VARCHAR) AS last_successful_run_id, CAST(NULL AS TIMESTAMP) AS watermark_updated_at
  FROM (SELECT * FROM led ORDER BY started_at DESC, run_id DESC LIMIT 3)
  UNION ALL SELECT 'committed_watermark', 2, NULL, NULL, NULL, NULL, NULL, NULL, source_name, entity_name, watermark_column, watermark_value, overlap_seconds, last_successful_run_id, updated_at FROM stored""",
    _LEDGER,
    _STORED,
)
_sql(
    "scalar_functions",
    """SELECT o_orderkey, sha256(o_orderstatus || '||' || o_orderkey) AS key2, sha256(CAST(o_orderkey AS VARCHAR)) AS key1, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(o_orderdate) AS INTEGER) AS y,
  CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS dom, CAST(isodow(o_orderdate) AS INTEGER) AS iso_day, monthname(o_orderdate) AS month_name,
  dayname(o_orderdate) AS day_name, CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE) + 1 AS DATE) AS next_day, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-09-01') AS INTEGER) AS age_days,
  lower(o_orderpriority) AS low, CAST(length(trim(o_orderpriority)) AS INTEGER) AS len, regexp_matches(o_orderpriority, '^[1-3]-') AS pressing, epoch_us(o_orderdate) AS micros,
  CAST(CASE WHEN o_orderkey % 10 = o_custkey % 10 THEN 1 ELSE 2 END AS INTEGER) AS distinct_digits, o_orderstatus = 'F' AS same, o_orderstatus IN ('F', 'O') AS listed, CAST(4 AS INTEGER) AS days FROM orders""",
    base=False,
)
_sql(
    "stream_latest_state",
    """SELECT user_id + 1 AS entity_id, ts AS at, event_type AS state, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    base=False,
)

_sql(
    "stream_change_feed",
    """SELECT user_id + 1 AS entity_id, 1::BIGINT AS n_inserts, 0::BIGINT AS n_unpaired, 0::BIGINT AS n_deletes, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    base=False,
)
_sql("stream_runs", "SELECT 'succeeded' AS status, max(ts) AS watermark FROM events", base=False)
_sql("workset_sink", "SELECT *, (SELECT count(*) FROM work) AS written FROM work", *_S)
_sql("repeated_changes", "SELECT issue_id, count(*) AS n_commits, CAST(max(_commit_version) AS BIGINT) AS last_version FROM real_i GROUP BY issue_id HAVING count(*) > 1", *_S)
_sql("business_values", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_values FROM ci" for c in _ISSUE_COLUMNS if c != "source_run_id"), *_S)
_sql(
    "unreadable_ranges",
    """SELECT 't' || c_nationkey AS source_table, c_custkey - 20 AS start_version, c_custkey + 20 AS end_version, a AS first_version, b AS last_version
  FROM customer JOIN (SELECT c_nationkey, min(c_custkey) AS a, max(c_custkey) AS b FROM customer GROUP BY c_nationkey) USING (c_nationkey) WHERE NOT (c_custkey - 20 >= a AND c_custkey + 20 <= b)""",
    base=False,
)
_sql(
    "batch_positions",
    """SELECT 'model' AS consumer_name, source_table, CAST(version AS BIGINT) AS last_version, 'run_4' AS last_run_id, TIMESTAMP '2001-09-06 11:00:00' AS updated_at
  FROM (SELECT 'issues' AS source_table, max(_commit_version) AS version FROM ci UNION ALL SELECT 'relations', max(_commit_version) FROM cr)""",
    *_S,
)
_sql("write_once", f"SELECT state, count(*) AS n_rows, CAST(sum(count(*)) OVER () AS BIGINT) AS written, false AS written_again FROM ({_latest("run_id = 'run_4'")}) GROUP BY state")
_sql(
    "invalid_manifests",
    """SELECT manifest_id, CASE length(repository_name) WHEN 5 THEN 'code_commit blank' WHEN 6 THEN 'no runs' WHEN 7 THEN 'runs repeat' ELSE 'bronze_version negative' END AS violations
  FROM man WHERE length(repository_name) BETWEEN 5 AND 8""",
    _MAN,
)
_sql(
    "older_invalid",
    f"SELECT issue_id, run_id AS source_run_id, batch AS _page_or_batch_reference FROM obs WHERE {_BAD} EXCEPT ALL SELECT issue_id, run_id, batch FROM ({_latest()}) WHERE {_BAD}",
)
_sql(
    "any_invalid",
    f"SELECT run_id AS _run_id, count(*) AS n_rows, v.log, CASE v.log WHEN 'flawed' THEN EXISTS (SELECT 1 FROM obs WHERE {_BAD}) ELSE false END AS any_invalid FROM obs CROSS JOIN (VALUES ('sound'), ('flawed')) v(log) GROUP BY ALL",
)
_sql("merge_source_duplicates", f"SELECT {_ISSUE}, count(*) AS n FROM obs WHERE run_id = 'run_1' GROUP BY ALL HAVING count(*) > 1")
_sql("missing_columns", "SELECT run_id AS _run_id, count(*) AS n_rows, v.column_name FROM obs CROSS JOIN (VALUES ('raw_json'), ('_ingested_at')) v(column_name) GROUP BY ALL")
_sql("utc_hours", "SELECT CAST(hour(ingested_at) AS INTEGER) AS hour, count(*) AS n_rows FROM obs GROUP BY ALL")
_sql("named_tables", "SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_totalprice >= 1000 GROUP BY ALL", base=False)
_sql("key_agreement", f"SELECT repository_owner, repository_name, {_RK} AS repository_key, count(*) AS n_relations FROM ({_relations()}) GROUP BY ALL")
_sql(
    "gate_failures",
    """SELECT 'fact_issue' AS table_name, * FROM (SELECT 'not_null' AS gate, 'closed_date_key' AS subject, count(*) FILTER (closed_at IS NULL) AS failures FROM l
  UNION ALL SELECT 'accepted_values', 'state', count(*) FILTER (state <> 'open') FROM l) WHERE failures > 0""",
    f"l AS ({_latest()})",
)
_sql("failed_run_watermark", "SELECT * FROM stored", _LEDGER, _STORED)
_sql(
    "moved_inputs",
    """SELECT source_table, a.version AS before_version, b.version AS after_version FROM (SELECT c_mktsegment AS source_table, count(DISTINCT c_nationkey) AS version FROM customer GROUP BY ALL) a
  FULL JOIN (SELECT c_mktsegment AS source_table, count(DISTINCT c_nationkey) AS version FROM customer WHERE c_acctbal < 0 GROUP BY ALL) b USING (source_table) WHERE a.version IS DISTINCT FROM b.version""",
    base=False,
)
