"""The registered queries as SQL for DuckDB."""

from __future__ import annotations

from ..sources.tables import ENTITY_SQL, ENV_TERMS, NAMED_SQL, ORDERS_SQL, REG_TERMS, ROLLUP_SQL, TECH_TERMS


def _list(terms: list[str]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"


TECH, ENV, REG = _list(TECH_TERMS), _list(ENV_TERMS), _list(REG_TERMS)
TECH_DIGITS = "(" + "|".join(TECH_TERMS) + ")[0-9]+"

PER_DAY_SQL = ROLLUP_SQL + """, resources_per_day AS (
  SELECT c.ResourceId, t.ResourceGroup, t.ResourceName, t.RegionId, t.RegionName, t.SubAccountId, t.SubAccountName, t.ResourceType,
         t.BillingAccountId, t.BillingAccountName, t.ProviderName, c.Tags, c.TotalEffectiveCost, c.year, c.month, c.day
  FROM (SELECT ResourceId, year, month, day, min(Tags) AS Tags, CAST(sum(EffectiveCost) AS DECIMAL(38,4)) AS TotalEffectiveCost
        FROM rollup_costs GROUP BY ALL) c
  LEFT JOIN (SELECT DISTINCT ResourceId, regexp_extract(ResourceId, '.*/resourcegroups/([^/]+)/.*', 1) AS ResourceGroup, ResourceName,
                    RegionId, RegionName, SubAccountId, SubAccountName, ResourceType, BillingAccountId, BillingAccountName, ProviderName, year, month, day
             FROM rollup_costs) t
    ON c.ResourceId = t.ResourceId AND c.year = t.year AND c.month = t.month AND c.day = t.day
), per_day_json AS (
  SELECT * REPLACE (CASE WHEN TRY_CAST(Tags AS JSON) IS NOT NULL THEN Tags END AS Tags) FROM resources_per_day
)"""

#: Names by tokens: DuckDB's patterns have no look-around, and with alphanumeric terms classes match whole tokens.
PHASE1_SQL = NAMED_SQL + f""", kept AS (
  SELECT *, coalesce(ResourceName, '') AS nm FROM named_resources WHERE ResourceType IS DISTINCT FROM 'Metric alert rule'
), classed AS (
  SELECT *, list_transform(regexp_extract_all(nm, '[A-Za-z0-9]+|[^A-Za-z0-9]+'), lambda t: {{'t': t, 'k':
    CASE WHEN regexp_full_match(t, '(?i)[a-f0-9]+') AND (length(regexp_replace(lower(t), '[^a-f]', '', 'g')) >= 2 OR length(t) >= 7) THEN 'HEX'
         WHEN list_contains({TECH}, lower(t)) THEN 'TECH' WHEN regexp_full_match(lower(t), '{TECH_DIGITS}') THEN 'TECHNUM'
         WHEN list_contains({ENV}, lower(t)) THEN 'ENV' WHEN list_contains({REG}, lower(t)) THEN 'REG'
         WHEN regexp_full_match(t, '[0-9]+') THEN 'NUM' ELSE '' END}}) AS tk FROM kept
), masked AS (
  SELECT *, array_to_string(list_transform(tk, lambda x: CASE x.k WHEN '' THEN x.t WHEN 'TECHNUM' THEN '⟂TECH⟂⟂NUM⟂' ELSE '⟂' || x.k || '⟂' END), '') AS MaskedName,
    trim(regexp_replace(array_to_string(list_transform(tk, lambda x: CASE x.k WHEN '' THEN x.t ELSE '' END), ''), '[-_.:/]+', '-', 'g'), '-_') AS ResidualPreview,
    CAST(length(nm) AS BIGINT) AS OriginalLength,
    CAST(coalesce(list_sum(list_transform(list_filter(tk, lambda x: x.k <> ''), lambda x: length(x.t))), 0) AS BIGINT) AS RemovedChars,
    CAST(len(list_filter(tk, lambda x: x.k = 'HEX')) AS BIGINT) AS MaskHitsHex,
    CAST(len(list_filter(tk, lambda x: x.k IN ('TECH', 'TECHNUM'))) AS BIGINT) AS MaskHitsTech,
    CAST(len(list_filter(tk, lambda x: x.k = 'ENV')) AS BIGINT) AS MaskHitsEnv, CAST(len(list_filter(tk, lambda x: x.k = 'REG')) AS BIGINT) AS MaskHitsReg,
    CAST(len(list_filter(tk, lambda x: x.k IN ('NUM', 'TECHNUM'))) AS BIGINT) AS MaskHitsNum
  FROM classed
), measured AS (
  SELECT *, CAST(length(ResidualPreview) AS BIGINT) AS ResidualLength, RemovedChars / greatest(OriginalLength, 1) AS PercentRemoved,
    coalesce(list_entropy(regexp_extract_all(nm, '.')), 0) AS EntropyOriginal, coalesce(list_entropy(regexp_extract_all(ResidualPreview, '.')), 0) AS EntropyResidual,
    CAST(0 AS BIGINT) AS MaskHitsGuid, MaskHitsHex + MaskHitsTech + MaskHitsEnv + MaskHitsReg + MaskHitsNum AS MaskHitsTotal,
    regexp_extract_all(ResidualPreview, '[A-Za-z]{{3,}}') AS runs, NOT contains(nm, '-') AND NOT contains(nm, '_') AS IsGlued
  FROM masked
), phase1 AS (
  SELECT *, PercentRemoved > 0.8 OR ResidualLength < 3 AS OverstripFlag,
    len(runs) > 0 AND len(list_filter(runs, lambda r: length(r) > 4)) = 0 AS AcronymOnlyResidual,
    PercentRemoved >= 0.5 OR MaskHitsTotal >= 3 AS HeavyScaffold,
    CASE WHEN IsGlued THEN list_filter(list_sort({ENV}), lambda e: contains(lower(nm), e)) ELSE [] END AS env_list,
    CASE WHEN IsGlued THEN list_sort(list_distinct(regexp_extract_all(lower(nm), '{TECH_DIGITS}', 1))) ELSE [] END AS tech_list
  FROM measured
)"""

SPANS_SQL = PHASE1_SQL + f""", occurrences AS (
  SELECT *, lower(Variant) AS Chunk FROM (SELECT *, unnest(regexp_extract_all(ResourceName, '[A-Za-z]{{3,}}')) AS Variant FROM phase1
    WHERE regexp_matches(ResourceName, '[-_.:/]+')) WHERE NOT list_contains({TECH} || {ENV} || {REG}, lower(Variant))
), forms AS (
  SELECT Chunk, Variant AS DisplayForm FROM (SELECT Chunk, Variant, row_number() OVER (PARTITION BY Chunk ORDER BY count(*) DESC,
    CASE WHEN Variant = lower(Variant) THEN 0 WHEN Variant = upper(Variant[1]) || lower(Variant[2:]) THEN 1 ELSE 2 END, Variant) AS rn
    FROM occurrences GROUP BY Chunk, Variant) WHERE rn = 1
), support AS (
  SELECT Chunk, CAST(length(Chunk) AS BIGINT) AS Length, count(DISTINCT ResourceId) AS SupportNames,
    count(DISTINCT SubAccountName) + max(CAST(SubAccountName IS NULL AS INT)) AS SpreadSubAccounts,
    count(DISTINCT ResourceGroup) + max(CAST(ResourceGroup IS NULL AS INT)) AS SpreadResourceGroups,
    min_by(ResourceName, ResourceId) AS SampleName1, max_by(ResourceName, ResourceId) AS SampleName2, CAST(sum(Cost) AS DECIMAL(38,4)) AS ChunkCost
  FROM occurrences GROUP BY Chunk
), freq AS (
  SELECT * FROM support JOIN forms USING (Chunk) WHERE SupportNames >= 3 ORDER BY Length DESC, SupportNames DESC, Chunk LIMIT 500
), cost AS (
  SELECT *, CAST(ChunkCost AS DOUBLE) / (SELECT CAST(sum(Cost) AS DOUBLE) FROM phase1) AS share FROM support JOIN forms USING (Chunk)
  WHERE CAST(ChunkCost AS DOUBLE) / (SELECT CAST(sum(Cost) AS DOUBLE) FROM phase1) >= 0.01
)"""

#: Chunks are blanked out the longest first; a glued name is one token, so classes match only whole names.
COVER_SQL = SPANS_SQL + f""", covered AS (
  SELECT *, list_reduce(list_prepend(lower(nm), (SELECT list(Chunk ORDER BY length(Chunk) DESC, Chunk) FROM freq)),
           lambda acc, c: replace(acc, c, repeat(chr(1), length(c)))) AS blank FROM phase1 WHERE IsGlued
), coverage AS (
  SELECT ResourceId, CAST(length(blank) - length(replace(blank, chr(1), '')) AS BIGINT) AS CoveredChars, blank = repeat(chr(1), length(blank)) OR whole AS GluedExplained, nm, whole, kind,
    CASE WHEN blank = repeat(chr(1), length(blank)) OR whole THEN -1 ELSE length(regexp_extract(blank, '^' || chr(1) || '*')) END AS off
  FROM (SELECT *, CASE WHEN list_contains({TECH}, lower(nm)) THEN 'TECH' WHEN list_contains({ENV}, lower(nm)) THEN 'ENV'
                       WHEN list_contains({REG}, lower(nm)) THEN 'REG' WHEN regexp_full_match(nm, '[0-9]+') THEN 'NUM' END AS kind,
               kind IS NOT NULL AS whole FROM covered)
)"""

RESIDUE_SQL = SPANS_SQL + """, cleaned AS (
  SELECT array_to_string(list_transform(tk, lambda x: CASE x.k WHEN '' THEN x.t ELSE '' END), '') AS residue FROM phase1
), residues AS (
  SELECT residue FROM cleaned WHERE length(residue) > 2
  AND NOT EXISTS (SELECT 1 FROM freq WHERE contains(residue, Chunk))
)"""

SCOPES_SQL = """(SELECT 'overall' AS ScopeType, 'overall' AS ScopeValue, * FROM {0}
  UNION ALL SELECT 'SubAccountName', SubAccountName, * FROM {0} WHERE SubAccountName IS NOT NULL
  UNION ALL SELECT 'ResourceGroup', ResourceGroup, * FROM {0} WHERE ResourceGroup IS NOT NULL
  UNION ALL SELECT 'BillingAccountName', BillingAccountName, * FROM {0} WHERE BillingAccountName IS NOT NULL)"""

PAIRS_SQL = ENTITY_SQL + """, grams AS (
  SELECT index, gram, count(*) AS tf FROM (
    SELECT index, unnest(list_transform(range(1, length(name) - n + 2), lambda i: substring(name, i, n))) AS gram FROM entity_names, (VALUES (3), (4), (5)) s(n)
  ) GROUP BY ALL
), raw AS (
  SELECT index, gram, tf * (ln((1.0 + (SELECT count(*) FROM entity_names)) / (1.0 + df)) + 1.0) AS w FROM grams JOIN (SELECT gram, count(*) AS df FROM grams GROUP BY gram) USING (gram)
), weights AS (
  SELECT index, gram, w / sqrt(sum(w * w) OVER (PARTITION BY index)) AS weight FROM raw
), pairs AS (
  SELECT a.index AS i, b.index AS j, sum(a.weight * b.weight) AS similarity FROM weights a JOIN weights b ON a.gram = b.gram AND a.index < b.index
  GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.8
), ends AS (
  SELECT i, j, similarity FROM pairs UNION ALL SELECT j, i, similarity FROM pairs
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY j) AS rn FROM ends
), links AS (
  SELECT least(i, j) AS i, greatest(i, j) AS j, max(similarity) AS similarity, CASE WHEN max(similarity) >= 0.92 THEN 'duplicate' ELSE 'related' END AS link_type
  FROM ranked WHERE rn <= 5 GROUP BY least(i, j), greatest(i, j) HAVING count(*) = 2 OR max(similarity) >= 0.95
), both_ways AS (
  SELECT i, j, similarity, link_type FROM links UNION ALL SELECT j, i, similarity, link_type FROM links
), reach AS (
  SELECT i AS node, i AS seen FROM both_ways UNION SELECT r.node, b.j FROM reach r JOIN both_ways b ON r.seen = b.i
), comps AS (
  SELECT node, min(seen) AS component FROM reach GROUP BY node
)"""

GROUPS_SQL = PAIRS_SQL + """, known AS (
  SELECT node, name, component, count(*) AS degree, avg(similarity) AS mean, max(similarity) AS best
  FROM comps JOIN both_ways ON node = i JOIN entity_names ON node = index GROUP BY ALL
), canon AS (
  SELECT component, node AS cnode, name AS canonical FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY degree DESC, mean DESC, name) AS rn FROM known) WHERE rn = 1
), members AS (
  SELECT canonical, name AS entity_name, round(coalesce(b.similarity, best), 3) AS similarity, coalesce(b.link_type, 'related') AS link_type
  FROM known JOIN canon USING (component) LEFT JOIN both_ways b ON b.i = node AND b.j = cnode WHERE node <> cnode
), p2 AS (
  SELECT name AS entity_name, CAST([] AS VARCHAR[]) AS abbreviations, [split_part(name, ' ', 1)] AS found_in_chunks FROM entity_names
), p3 AS (
  SELECT name AS entity_name, [substring(name, 1, 3)] AS abbreviations, [split_part(name, ' ', -1)] AS found_in_chunks FROM entity_names WHERE index % 3 = 0
), merged AS (
  SELECT p2.entity_name, list_sort(list_distinct(p2.abbreviations || coalesce(p3.abbreviations, []))) AS abbreviations,
    list_sort(list_distinct(p2.found_in_chunks || coalesce(p3.found_in_chunks, []))) AS found_in_chunks,
    CASE WHEN p3.entity_name IS NULL THEN 'statistical' ELSE 'statistical|llm_inferred' END AS validation_source
  FROM p2 LEFT JOIN p3 USING (entity_name)
), listed AS (
  SELECT canonical, entity_name FROM members UNION SELECT canonical, canonical FROM members
), master AS (
  SELECT canonical, list_sort(list_distinct(flatten(list(abbreviations)))) AS abbreviations, list_sort(list_distinct(flatten(list(found_in_chunks)))) AS found_in_chunks,
    (SELECT count(*) FROM members m WHERE m.canonical = l.canonical) AS n_members FROM listed l JOIN merged USING (entity_name) GROUP BY canonical
)"""

COSTS_SQL = GROUPS_SQL + ", " + NAMED_SQL + """, every AS (
  SELECT canonical AS entity_name, found_in_chunks, n_members AS num_members FROM master
  UNION ALL SELECT entity_name, found_in_chunks, 0 FROM merged WHERE entity_name NOT IN (SELECT entity_name FROM listed)
), entity_costs AS (
  SELECT entity_name, num_members, CAST(coalesce(sum(Cost), 0) AS DECIMAL(38,4)) AS cost
  FROM every LEFT JOIN named_resources ON ResourceName IS NOT NULL AND len(list_filter(found_in_chunks, lambda c: contains(lower(ResourceName), lower(c)))) > 0
  WHERE len(found_in_chunks) > 0 GROUP BY entity_name, num_members
)"""

REPORT_COLUMNS = "ResourceId, MaskedName, ResidualPreview, OriginalLength, RemovedChars, round(PercentRemoved, 6) AS PercentRemoved, ResidualLength, round(EntropyOriginal, 6) AS EntropyOriginal, round(EntropyResidual, 6) AS EntropyResidual, MaskHitsTotal, MaskHitsGuid, MaskHitsHex, MaskHitsTech, MaskHitsEnv, MaskHitsReg, MaskHitsNum"
MONTH = "year = 1996 AND month = '12'"


def _bin(column: str, bins: int) -> str:
    return f"CAST(coalesce(least(floor((CAST({column} AS DOUBLE) - (SELECT min({column}) FROM phase1)) / nullif(CAST((SELECT max({column}) FROM phase1) - (SELECT min({column}) FROM phase1) AS DOUBLE), 0) * {bins}), {bins - 1}), 0) AS BIGINT)"


def _rate(column: str) -> str:
    return f"round(avg(CAST({column} AS DOUBLE)), 6)"


ROLLUP_COLUMNS = f"""ScopeType, ScopeValue, count(*) AS ResourceCount, round(avg(PercentRemoved), 6) AS PctRemovedMean, round(quantile_cont(PercentRemoved, 0.5), 6) AS PctRemovedMedian,
  round(quantile_cont(PercentRemoved, 0.9), 6) AS PctRemovedP90, round(avg(ResidualLength), 6) AS ResidualLenMean, round(quantile_cont(ResidualLength, 0.5), 6) AS ResidualLenMedian,
  round(quantile_cont(ResidualLength, 0.1), 6) AS ResidualLenP10, round(avg(EntropyOriginal), 6) AS EntropyOrigMean, round(quantile_cont(EntropyOriginal, 0.5), 6) AS EntropyOrigMedian,
  round(avg(EntropyResidual), 6) AS EntropyResidMean, round(quantile_cont(EntropyResidual, 0.5), 6) AS EntropyResidMedian, {_rate('OverstripFlag')} AS OverstripFlagRate,
  {_rate('IsGlued')} AS IsGluedRate, {_rate('AcronymOnlyResidual')} AS AcronymOnlyResidualRate, {_rate('HeavyScaffold')} AS HeavyScaffoldRate, {_rate('len(env_list) >= 2')} AS EnvConflictRate,
  {_rate('CASE WHEN IsGlued THEN GluedExplained END')} AS GluedExplainedRate, {_rate('CASE WHEN IsGlued THEN len(env_list) > 0 END')} AS EmbeddedEnvRate"""

STATES_SQL = f"""WITH {PER_DAY_SQL}, tagged AS (
  SELECT *, (SELECT string_agg(t.s.Key || '=' || coalesce(t.s.Value, ''), ';' ORDER BY t.s.Key, t.s.Value)
             FROM unnest(json_transform(Tags, '[{{"Key": "VARCHAR", "Value": "VARCHAR"}}]')) AS t(s) WHERE t.s.Key IS NOT NULL) AS n FROM per_day_json)
SELECT make_date(year, CAST(month AS INTEGER), CAST(day AS INTEGER)) AS SnapshotDate, ResourceId, ResourceGroup, ResourceName, ResourceType, SubAccountId, SubAccountName,
  RegionId, RegionName, BillingAccountId, BillingAccountName, ProviderName, Tags,
  md5(ResourceId || '|#|' || coalesce(ResourceGroup, '') || '|#|' || coalesce(ResourceName, '') || '|#|' || coalesce(SubAccountId, '') || '|#|' || coalesce(BillingAccountName, '') || '|#|' || coalesce(RegionId, '') || '|#|' || coalesce(n, '')) AS state_hash,
  md5(coalesce(ResourceGroup, '') || '|#|' || coalesce(ResourceName, '') || '|#|' || coalesce(ResourceType, '') || '|#|' || coalesce(SubAccountId, '') || '|#|' || coalesce(BillingAccountName, '') || '|#|' || coalesce(RegionId, '') || '|#|' || coalesce(n, '')) AS full_state_hash
FROM tagged"""

ORACLE_SQL: dict[str, str] = {
    "resources_per_day": f"WITH {PER_DAY_SQL} SELECT * FROM resources_per_day",
    "resources_per_day_json": f"WITH {PER_DAY_SQL} SELECT * FROM per_day_json",
    "state_hashes": STATES_SQL,
    "monthly_resource_cost": f"""WITH {PER_DAY_SQL} SELECT ResourceId, max(ResourceName) AS ResourceName, max(ResourceType) AS ResourceType, CAST(sum(TotalEffectiveCost) AS DECIMAL(38,4)) AS Cost,
  max(BillingAccountName) AS BillingAccountName, max(SubAccountName) AS SubAccountName, max(CASE WHEN rn = 1 THEN Tags END) AS Tags,
  nullif(regexp_extract(ResourceId, '(?i)/resourceGroups/([^/]+)', 1), '') AS ResourceGroup
FROM (SELECT *, row_number() OVER (PARTITION BY ResourceId ORDER BY day DESC, Tags DESC NULLS LAST) AS rn FROM per_day_json WHERE {MONTH}) GROUP BY ResourceId""",
    "tags_index": f"WITH {NAMED_SQL} SELECT ResourceId, BillingAccountName, SubAccountName, e.key AS tag_key, e.value ->> '$' AS tag_value FROM named_resources, json_each(Tags) e",
    "tag_json_parse": "SELECT event_id, CAST(coalesce(len(json_keys(props)), 0) AS BIGINT) AS n_pairs, coalesce(array_to_string(list_transform(json_keys(props), lambda k: k || '=' || json_extract_string(props, '$.' || k)), ';'), '') AS pairs FROM events",
    "resource_group_extract": f"WITH {ROLLUP_SQL} SELECT DISTINCT ResourceId, regexp_extract(ResourceId, '.*/resourcegroups/([^/]+)/.*', 1) AS day_group, nullif(regexp_extract(ResourceId, '(?i)/resourceGroups/([^/]+)', 1), '') AS month_group FROM rollup_costs",
    "date_parse": "SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN date_trunc('day', o_orderdate) WHEN 2 THEN date_trunc('second', o_orderdate) - INTERVAL 2 HOUR WHEN 3 THEN NULL WHEN 4 THEN TIMESTAMP '1970-01-01' ELSE date_trunc('second', o_orderdate) END AS TIMESTAMP) AS parsed FROM orders",
    "decimal_parse": "SELECT o_orderkey, CAST(CASE o_orderkey % 5 WHEN 1 THEN (1000 + trunc(o_totalprice * 100)::BIGINT % 1000)::DECIMAL(18,4) WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE trunc(o_totalprice * 100)::BIGINT::DECIMAL(18,4) / 100 END AS DECIMAL(18,4)) AS cost FROM orders",
    "charge_period_check": "SELECT l_linenumber, coalesce(CASE WHEN l_linenumber = 4 THEN NULL ELSE l_linenumber % 3 = 1 END, false) AS daily, count(*) AS n FROM lineitem GROUP BY ALL",
    "null_safe_filter": f"WITH {NAMED_SQL} SELECT ResourceType, count(*) AS n FROM named_resources WHERE ResourceType IS DISTINCT FROM 'Metric alert rule' GROUP BY ResourceType",
    "entropy": "SELECT page_id, round(coalesce(list_entropy(regexp_extract_all(url, '.')), 0), 6) AS entropy FROM pages",
    "mask_report": f"WITH {PHASE1_SQL} SELECT {REPORT_COLUMNS} FROM phase1",
    "phase1_flags": f"WITH {PHASE1_SQL} SELECT ResourceId, OverstripFlag, AcronymOnlyResidual, HeavyScaffold, IsGlued, len(env_list) >= 2 AS EnvConflict FROM phase1",
    "embedded_terms": f"WITH {PHASE1_SQL} SELECT ResourceId, coalesce(array_to_string(env_list, '|'), '') AS env, coalesce(array_to_string(tech_list, '|'), '') AS tech FROM phase1 WHERE IsGlued",
    "protect_freq": f"WITH {SPANS_SQL} SELECT Chunk, DisplayForm, Length, SupportNames, SpreadSubAccounts, SpreadResourceGroups, SampleName1, SampleName2 FROM freq",
    "protect_cost": f"WITH {SPANS_SQL} SELECT Chunk, DisplayForm, SupportNames, ChunkCost AS TotalCost, round(share, 6) AS CostPercentOfTotal FROM cost",
    "protect_combined": f"""WITH {SPANS_SQL} SELECT Chunk, SupportNames, TotalCost, InFrequencySet, InCostSet,
  CASE WHEN InFrequencySet AND InCostSet THEN 'Both (Freq & Cost)' WHEN InFrequencySet THEN 'Frequency Only' WHEN InCostSet THEN 'Cost Only' ELSE 'Other' END AS category,
  CASE WHEN SupportNames > 0 THEN CAST(SupportNames AS DOUBLE) ELSE 1.0::DOUBLE END AS log_support, round(CASE WHEN TotalCost > 0 THEN CAST(TotalCost AS DOUBLE) ELSE 0.01::DOUBLE END, 4) AS log_cost, scaled_spread
FROM (SELECT coalesce(f.Chunk, c.Chunk) AS Chunk, coalesce(f.SupportNames, c.SupportNames) AS SupportNames, coalesce(c.ChunkCost, 0) AS TotalCost, f.Chunk IS NOT NULL AS InFrequencySet,
  c.Chunk IS NOT NULL AS InCostSet, CAST(coalesce(f.SpreadSubAccounts, c.SpreadSubAccounts) * 5 AS BIGINT) AS scaled_spread FROM freq f FULL JOIN cost c ON f.Chunk = c.Chunk)""",
    "suggested_entities": f"""WITH {SPANS_SQL} SELECT Chunk AS entity_name, count(*) AS n_names, md5(string_agg(ResourceName, '|' ORDER BY ResourceName)) AS names_md5
FROM freq JOIN (SELECT DISTINCT ResourceName FROM phase1 WHERE ResourceName IS NOT NULL) ON contains(lower(ResourceName), Chunk) GROUP BY Chunk""",
    "glued_coverage": f"WITH {COVER_SQL} SELECT ResourceId, CoveredChars, GluedExplained, CAST(off AS BIGINT) AS CoverageFailOffset, CASE WHEN GluedExplained THEN CASE WHEN whole THEN '⟂' || kind || '⟂' ELSE nm END END AS GluedMaskedString FROM coverage",
    "hit_lists": f"""WITH {COVER_SQL}, chunks AS (
  SELECT list({{'t': Chunk, 'h': CAST([] AS STRUCT(c VARCHAR, s BIGINT)[])}} ORDER BY length(Chunk) DESC, Chunk) AS l FROM freq
), met AS (
  SELECT ResourceId, list_reduce(l, lambda a, c: {{'t': replace(a.t, c.t, repeat(chr(1), length(c.t))), 'h': a.h || list_transform(list_filter(range(length(a.t)), lambda i: substring(a.t, i + 1, length(c.t)) = c.t), lambda i: {{'c': c.t, 's': i}})}},
    {{'t': lower(nm), 'h': CAST([] AS STRUCT(c VARCHAR, s BIGINT)[])}}) AS a FROM phase1, chunks WHERE IsGlued
)
SELECT ResourceId, 'chunk' AS kind, x.c AS found, x.s AS start, CAST(x.s + length(x.c) AS BIGINT) AS "end" FROM (SELECT ResourceId, unnest(a.h) AS x FROM met)
UNION ALL SELECT ResourceId, 'class', kind, 0, CAST(length(nm) AS BIGINT) FROM coverage WHERE whole AND kind IS NOT NULL""",
    "corpus_rollup": f"WITH {COVER_SQL}, joined AS (SELECT p.*, c.GluedExplained FROM phase1 p LEFT JOIN coverage c USING (ResourceId)) SELECT {ROLLUP_COLUMNS} FROM {SCOPES_SQL.format('joined')} GROUP BY ScopeType, ScopeValue",
    "topn_scopes": f"WITH {PHASE1_SQL} SELECT 'BillingAccountName' AS ScopeType, BillingAccountName AS ScopeValue, round(avg(PercentRemoved), 6) AS PctRemovedMean FROM phase1 GROUP BY BillingAccountName ORDER BY avg(PercentRemoved) DESC, BillingAccountName LIMIT 15",
    "top_tokens": f"""WITH {PHASE1_SQL}, tokens AS (
  SELECT ScopeType, ScopeValue, unnest(regexp_extract_all(lower(ResourceName), '[a-z0-9]+')) AS Token FROM {SCOPES_SQL.format('phase1')}
), counted AS (
  SELECT ScopeType, ScopeValue, Token, CASE WHEN list_contains({TECH}, Token) THEN 'TECH' WHEN list_contains({ENV}, Token) THEN 'ENV' ELSE 'REG' END AS k, count(*) AS n
  FROM tokens WHERE list_contains({TECH} || {ENV} || {REG}, Token) GROUP BY ALL
), best AS (
  SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY ScopeType, ScopeValue, k ORDER BY n DESC, length(Token) DESC, Token) <= 5
) SELECT ScopeType, ScopeValue, {", ".join(f"coalesce(string_agg(Token || ':' || n, '|' ORDER BY n DESC, length(Token) DESC, Token) FILTER (WHERE k = '{k}'), '') AS Top{k.title()}Tokens" for k in ("TECH", "ENV", "REG"))}
FROM best GROUP BY ScopeType, ScopeValue""",
    "residue": f"WITH {RESIDUE_SQL} SELECT residue, count(*) AS n FROM residues GROUP BY residue",
    "extracted_entities": f"""WITH {RESIDUE_SQL}, best AS (
  SELECT residue, list_sort(list_transform(regexp_extract_all(residue, '[A-Za-z]{{3,}}'), lambda w: {{'n': length(w), 'w': w}}), 'DESC')[1].w AS word FROM (SELECT DISTINCT residue FROM residues))
SELECT lower(word) AS entity_name, count(*) AS n_residues FROM best WHERE word IS NOT NULL GROUP BY lower(word)""",
    "tfidf_pairs": f"WITH RECURSIVE {PAIRS_SQL} SELECT i, j, round(similarity, 6) AS similarity FROM pairs",
    "entity_links": f"WITH RECURSIVE {PAIRS_SQL} SELECT i, j, round(similarity, 6) AS similarity, link_type FROM links",
    "components": f"WITH RECURSIVE {PAIRS_SQL} SELECT node, component FROM comps",
    "entity_groups": f"WITH RECURSIVE {GROUPS_SQL} SELECT canonical, entity_name, similarity, link_type FROM members",
    "entity_merge": f"WITH RECURSIVE {GROUPS_SQL} SELECT entity_name, array_to_string(abbreviations, '|') AS abbreviations, array_to_string(found_in_chunks, '|') AS found_in_chunks, validation_source FROM merged",
    "master_groups": f"WITH RECURSIVE {GROUPS_SQL} SELECT canonical, array_to_string(abbreviations, '|') AS abbreviations, array_to_string(found_in_chunks, '|') AS found_in_chunks, 'pending' AS status, n_members FROM master",
    "entity_cost_coverage": f"""WITH RECURSIVE {COSTS_SQL} SELECT entity_name, num_members, cost, round(pct, 4) AS cost_pct_of_total,
  round(sum(pct) OVER (ORDER BY cost DESC, entity_name ROWS UNBOUNDED PRECEDING), 4) AS cumulative_cost_pct
FROM (SELECT *, CAST(cost AS DOUBLE) / (SELECT CAST(sum(Cost) AS DOUBLE) FROM named_resources) * 100 AS pct FROM entity_costs)""",
    "top_coverage": f"""WITH RECURSIVE {COSTS_SQL} SELECT round(sum(pct), 4) AS coverage_pct FROM (
  SELECT CAST(cost AS DOUBLE) / (SELECT CAST(sum(Cost) AS DOUBLE) FROM named_resources) * 100 AS pct FROM entity_costs ORDER BY cost DESC, entity_name LIMIT 10)""",
    "top_groups": f"WITH RECURSIVE {COSTS_SQL} SELECT entity_name, num_members, cost FROM entity_costs WHERE num_members > 0 ORDER BY cost DESC, entity_name LIMIT 15",
    "scorecard": f"""WITH RECURSIVE {COSTS_SQL}, n AS (SELECT (SELECT count(DISTINCT canonical) FROM members) AS num_groups, (SELECT count(*) FROM members) AS num_members,
  (SELECT count(*) FROM members WHERE link_type = 'duplicate') AS duplicate_count, (SELECT count(*) FROM members WHERE link_type = 'related') AS related_count,
  (SELECT count(*) FROM merged WHERE entity_name NOT IN (SELECT entity_name FROM listed)) AS num_distinct,
  (SELECT CAST(coalesce(sum(cost), 0) AS DECIMAL(38,4)) FROM entity_costs WHERE num_members > 0) AS at_risk_cost)
SELECT *, round(CASE WHEN num_groups + num_distinct > 0 THEN (num_members + num_groups) / (num_groups + num_distinct) ELSE 0.0 END, 6) AS consolidation_ratio FROM n""",
    "histogram": f"WITH {PHASE1_SQL} SELECT {_bin('ResidualLength', 50)} AS bin, count(*) AS n FROM phase1 GROUP BY bin",
    "density": f"WITH {PHASE1_SQL} SELECT {_bin('OriginalLength', 20)} AS x_bin, {_bin('ResidualLength', 20)} AS y_bin, count(*) AS n FROM phase1 GROUP BY ALL",
    "csv_roundtrip": f"""WITH {ROLLUP_SQL} SELECT year, month, day, count(*) AS n, CAST(sum(EffectiveCost) AS DECIMAL(38,4)) AS cost, count(ResourceId) AS with_id, 'a, "b"' AS service
FROM rollup_costs GROUP BY year, month, day""",
    "ingest_ledger": f"WITH {ORDERS_SQL} SELECT folder, count(*) FILTER (NOT bad) AS n_rows, count(*) FILTER (bad) AS refused, count(*) FILTER (odd AND NOT bad) AS rejected_cells, NULL::BOOLEAN AS failed FROM order_costs GROUP BY folder UNION ALL SELECT 9, 0, 0, 0, count(*) > 0 FROM nation",
    "refused_lines": f"WITH {ORDERS_SQL} SELECT folder, key, CASE key % 41 WHEN 0 THEN '3' ELSE '51' END || ' fields for 50 columns' AS reason FROM order_costs WHERE bad",
    "replayed_batches": f"""WITH {ORDERS_SQL} SELECT CAST(year(date) AS BIGINT) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day, count(*) AS n, CAST(sum(cost) AS DECIMAL(38,2)) AS cost
FROM order_costs WHERE NOT bad GROUP BY date""",
    "ordered_views": f"SELECT SnapshotDate, count(*) AS n, count(DISTINCT state_hash) AS states FROM ({STATES_SQL}) GROUP BY SnapshotDate",
    "guid_masks": """SELECT CAST(o_orderkey AS VARCHAR) AS ResourceId, CASE o_orderkey % 4 WHEN 0 THEN 'app-⟂GUID⟂-⟂ENV⟂' WHEN 1 THEN 'app_⟂GUID⟂' WHEN 2 THEN 'zz' || md5(CAST(o_orderkey AS VARCHAR)) || 'zz' ELSE '/⟂GUID⟂.⟂GUID⟂:' END AS MaskedName,
  [1, 1, 0, 2][o_orderkey % 4 + 1] AS MaskHitsGuid, [40, 32, 0, 68][o_orderkey % 4 + 1] AS RemovedChars, [3, 3, 36, 0][o_orderkey % 4 + 1] AS ResidualLength FROM orders""",
    "nfkc_names": "SELECT p_partkey, lower(p_brand) || ['fi', 'ab', chr(233), '1', chr(229), 'plain'][p_partkey % 6 + 1] AS name FROM part",
    "ingest_days": f"WITH {ORDERS_SQL} SELECT strftime(date, '%Y-%m-%d') AS day, count(*) AS n FROM order_costs WHERE NOT bad GROUP BY date",
    "registered_source": f"""WITH {ORDERS_SQL} SELECT CAST(year(date) AS BIGINT) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day, count(*) AS n, CAST(sum(cost) AS DECIMAL(38,2)) AS cost
FROM order_costs WHERE NOT bad AND year(date) >= 1995 GROUP BY date""",
    "merged_lists": f"WITH RECURSIVE {GROUPS_SQL} SELECT entity_name, array_to_string(abbreviations, '|') AS abbreviations, array_to_string(found_in_chunks, '|') AS found_in_chunks, validation_source FROM merged",
    "acronyms": """SELECT p_partkey, coalesce(array_to_string(list_filter(string_split(p_name, ' ') || string_split(p_type, ' ') || string_split(p_brand, '#'), lambda w: regexp_full_match(w, '[A-Za-z]{3,5}')), '|'), '') AS abbreviations FROM part""",
    "incremental_days": f"""WITH {ORDERS_SQL} SELECT resource AS ResourceId, 'g' || (key % 10) AS ResourceGroup, 'a, "b"' AS ProviderName, CAST(sum(cost) AS DECIMAL(38,4)) AS TotalEffectiveCost,
  CAST(year(date) AS BIGINT) AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day FROM order_costs WHERE NOT bad GROUP BY resource, key % 10, date""",
    "incremental_months": f"""WITH {ORDERS_SQL} SELECT resource AS ResourceId, 'g' || (key % 10) AS ResourceGroup, CAST(sum(cost) AS DECIMAL(38,4)) AS Cost, '{{}}' AS Tags,
  CAST(year(date) AS BIGINT) AS year, strftime(date, '%m') AS month FROM order_costs WHERE NOT bad GROUP BY resource, key % 10, date""",
    "csv_roundtrip_days": f"""WITH {ROLLUP_SQL} SELECT year, month, day, count(*) AS n, CAST(sum(EffectiveCost) AS DECIMAL(38,4)) AS cost, count(ResourceId) AS with_id, 'a, "b"' AS service
FROM rollup_costs GROUP BY year, month, day""",
    "violin": f"""WITH {PHASE1_SQL}, sized AS (
  SELECT HeavyScaffold, count(*) AS size, min(RemovedChars) AS low, max(RemovedChars) AS high, coalesce(stddev_samp(RemovedChars), 0) AS sd,
    quantile_cont(CAST(RemovedChars AS DOUBLE), 0.75) - quantile_cont(CAST(RemovedChars AS DOUBLE), 0.25) AS iqr FROM phase1 GROUP BY HeavyScaffold
), wide AS (
  SELECT *, 1.059 * CASE WHEN iqr > 0 THEN least(sd, iqr / 1.349) ELSE sd END * pow(size, -0.2) AS h FROM sized
), places AS (
  SELECT *, k, low - 2 * h + k * (high - low + 4 * h) / 63 AS x FROM wide, (SELECT unnest(range(64)) AS k) WHERE h > 0
)
SELECT l.HeavyScaffold, k AS point, round(x, 7) AS x, round(sum(exp(-0.5 * pow((x - RemovedChars) / h, 2))) / (sqrt(2 * pi()) * any_value(h) * any_value(size)), 7) AS density
FROM places l JOIN phase1 p ON l.HeavyScaffold = p.HeavyScaffold GROUP BY l.HeavyScaffold, k, x
UNION ALL SELECT HeavyScaffold, 0, CAST(low AS DOUBLE), 1.0::DOUBLE FROM wide WHERE h = 0""",
    "box": f"""WITH {PHASE1_SQL} SELECT SubAccountName, CAST(min(RemovedChars) AS DOUBLE) AS low, CAST(quantile_cont(RemovedChars, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont(RemovedChars, 0.5) AS DOUBLE) AS median,
  CAST(quantile_cont(RemovedChars, 0.75) AS DOUBLE) AS q3, CAST(max(RemovedChars) AS DOUBLE) AS high FROM phase1 GROUP BY SubAccountName""",
}
