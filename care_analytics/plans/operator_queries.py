"""One registered query per operator of the inventory.

Each runs a single operator from the library over whole adapter tables and
has an independent DuckDB oracle.  An id column is kept in every output so
rows stay distinguishable.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from care_analytics.functions import patterns
from care_analytics.functions import scalars as S
from care_analytics.operators import aggregates as A
from care_analytics.operators import filters as FL
from care_analytics.operators import joins as J
from care_analytics.operators import temporal as T
from care_analytics.operators import text as TX
from care_analytics.operators import windows as W

c = F.col
D = dt.date(1998, 9, 1)
S0 = dt.date(1998, 3, 1)
MOMENT = dt.datetime(1998, 9, 1, 12, 0)

OPERATORS: dict = {}


def register(name, oracle):
    def deco(fn):
        OPERATORS[name] = (fn, oracle)
        return fn
    return deco


# -- projection ---------------------------------------------------------------
@register("project_rename", """
SELECT objectId AS location_id, name AS location_name, identificationNo AS location_no,
       intramuralLocation AS intramural FROM fx_locations""")
def project_rename(t):
    return t.locations.select(c("objectId").alias("location_id"), c("name").alias("location_name"),
                              c("identificationNo").alias("location_no"),
                              c("intramuralLocation").alias("intramural"))


@register("sorted_multi_key", "SELECT objectId, lastName, firstName FROM fx_clients")
def sorted_multi_key(t):
    df = t.clients.select("objectId", "lastName", "firstName")
    return df.orderBy(*TX.in_order(df, "lastName", "firstName", "objectId"))


@register("sorted_text", "SELECT objectId, segment, city FROM fx_spellings")
def sorted_text(t):
    df = t.view("fx_spellings").select("objectId", "segment", "city")
    return df.orderBy(*TX.in_order(df, "segment", "city"))


@register("distinct_text", """
SELECT s.segment, s.city FROM (
  SELECT min({'segment': segment, 'city': city}) AS s FROM fx_spellings
  GROUP BY rtrim(segment, ' ') COLLATE NOCASE, rtrim(city, ' ') COLLATE NOCASE)""")
def distinct_text(t):
    return TX.distinct_rows(t.view("fx_spellings").select("segment", "city"))


@register("group_by_text", """
SELECT min(segment) AS segment, nation, COUNT(*) AS n, CAST(SUM(balance) AS DECIMAL(38,2)) AS balance
FROM fx_spellings GROUP BY rtrim(segment, ' ') COLLATE NOCASE, nation""")
def group_by_text(t):
    df = t.view("fx_spellings")
    return TX.grouped(df, ["segment", "nation"], F.count(F.lit(1)).alias("n"), F.sum("balance").cast("decimal(38,2)").alias("balance"))


@register("text_code_join", """
SELECT a.objectId, b.code FROM fx_spellings a
JOIN (SELECT DISTINCT rtrim(lower(segment), ' ') AS code FROM fx_spellings) b ON rtrim(a.segment, ' ') COLLATE NOCASE = b.code""")
def text_code_join(t):
    a = t.view("fx_spellings")
    codes = TX.distinct_rows(a.select("segment")).select(F.lower(F.rtrim("segment")).alias("code"))
    return a.join(codes, TX.as_text("segment") == TX.as_text("code")).select("objectId", "code")


@register("distinct_pairs", """
SELECT DISTINCT i.eventObjectId, ol.externalObjectId AS locationExternalObjectId
FROM fx_agenda_invitations i JOIN fx_agenda_locations ol ON ol.objectId = i.inviteeObjectId""")
def distinct_pairs(t):
    i, ol = t.agenda_invitations.alias("i"), t.onsagenda_locations.alias("ol")
    return (i.join(ol, c("ol.objectId") == c("i.inviteeObjectId"))
            .select(c("i.eventObjectId").alias("eventObjectId"),
                    c("ol.externalObjectId").alias("locationExternalObjectId")).distinct())


@register("polymorphic_bridge", """
SELECT i.objectId, i.eventObjectId, i.inviteeObjectId, 'client' AS invitee_kind,
       CAST(NULL AS BIGINT) AS locationExternalObjectId
FROM fx_agenda_invitations i JOIN fx_agenda_clients oc ON oc.objectId = i.inviteeObjectId
UNION ALL
SELECT i.objectId, i.eventObjectId, i.inviteeObjectId, 'location', ol.externalObjectId
FROM fx_agenda_invitations i JOIN fx_agenda_locations ol ON ol.objectId = i.inviteeObjectId""")
def polymorphic_bridge(t):
    oc, ol = t.onsagenda_clients, t.onsagenda_locations
    return J.polymorphic_bridge(t.agenda_invitations, "inviteeObjectId", [
        ("client", oc, "objectId", {}),
        ("location", ol, "objectId", {"locationExternalObjectId": ol["externalObjectId"]}),
    ])


# -- filters ------------------------------------------------------------------
@register("filter_ci_eq", "SELECT objectId, locationType FROM fx_location_assignments WHERE lower(locationType) = 'main'")
def filter_ci_eq(t):
    return FL.where(t.location_assignments, FL.ci_eq("locationType", "main")).select("objectId", "locationType")


@register("filter_open_rows", "SELECT objectId, clientObjectId, beginDate FROM fx_location_assignments WHERE endDate IS NULL")
def filter_open_rows(t):
    return t.location_assignments.filter(c("endDate").isNull()).select("objectId", "clientObjectId", "beginDate")


@register("filter_not_flag", "SELECT objectId, dummy FROM fx_shift_employees WHERE dummy <> 1")
def filter_not_flag(t):
    return FL.where(t.moves_employees, FL.not_flag("dummy", 1)).select("objectId", "dummy")


@register("filter_date_range", """
SELECT objectId, expenseDate, amount FROM fx_expenses
WHERE CAST(expenseDate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'""")
def filter_date_range(t):
    return FL.where(t.expenses, FL.in_period("expenseDate", "1998-01-01", "1998-01-31")).select(
        "objectId", "expenseDate", "amount")


@register("cast_to_date", "SELECT objectId, CAST(startDate AS DATE) AS start_day FROM fx_presence_logs")
def cast_to_date(t):
    return t.presence_logs.select("objectId", c("startDate").cast("date").alias("start_day"))


@register("filter_like", "SELECT objectId, legitimatie FROM fx_entitlements WHERE legitimatie ILIKE '%jw%'")
def filter_like(t):
    return t.legitimaties.filter(patterns.like(c("legitimatie"), "%jw%")).select("objectId", "legitimatie")


@register("match_any_patterns", """
SELECT objectId, name FROM fx_expense_types WHERE name ILIKE '%gear%' OR name ILIKE 'red%'""")
def match_any_patterns(t):
    return FL.where(t.expense_types, FL.like_any("name", "%gear%,red%")).select("objectId", "name")


@register("match_none_patterns", """
SELECT objectId, name FROM fx_locations l
WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('wachtlijst')) x(v) WHERE l.name ILIKE '%' || trim(x.v) || '%')""")
def match_none_patterns(t):
    return FL.where(t.locations, FL.contains_none("name", "wachtlijst")).select("objectId", "name")


@register("token_membership", "SELECT objectId, surveyObjectId FROM fx_survey_results WHERE objectId IN (1, 25)")
def token_membership(t):
    return FL.where(t.survey_results, FL.in_tokens("objectId", " 1 , ,25,x", numeric=True)).select(
        "objectId", "surveyObjectId")


@register("text_number_range", """
SELECT objectId, identificationNo FROM fx_costcenters
WHERE TRY_CAST(identificationNo AS INTEGER) BETWEEN 1000 AND 3000""")
def text_number_range(t):
    return FL.where(t.costcenters, FL.in_text_range("identificationNo", "1000-3000")).select(
        "objectId", "identificationNo")


@register("flexible_number_filter", """
SELECT objectId, identificationNo FROM fx_costcenters WHERE identificationNo IN ('1200', '1500')""")
def flexible_number_filter(t):
    return FL.where(t.costcenters, FL.flex_number("identificationNo", "1200,1500")).select(
        "objectId", "identificationNo")


@register("period_overlap_inclusive", """
SELECT objectId, datumAanvang, datumBeeindiging FROM fx_youth_trajectories
WHERE datumAanvang <= DATE '1998-09-01' AND (datumBeeindiging IS NULL OR datumBeeindiging >= DATE '1998-03-01')""")
def period_overlap_inclusive(t):
    return FL.where(t.cbsbj_jeugdhulps,
                    T.overlaps("datumAanvang", "datumBeeindiging", S0, D, end_inclusive=True)).select(
        "objectId", "datumAanvang", "datumBeeindiging")


@register("period_overlap_exclusive", """
SELECT objectId, van, tot FROM fx_entitlements
WHERE van <= DATE '1998-09-01' AND (tot IS NULL OR tot > DATE '1998-03-01')""")
def period_overlap_exclusive(t):
    return FL.where(t.legitimaties, T.overlaps("van", "tot", S0, D, end_inclusive=False)).select(
        "objectId", "van", "tot")


@register("valid_at_date", """
SELECT objectId, beginDate, endDate FROM fx_location_assignments
WHERE beginDate <= DATE '1998-09-01' AND (endDate IS NULL OR endDate >= DATE '1998-09-01')""")
def valid_at_date(t):
    return FL.where(t.location_assignments,
                    T.valid_at("beginDate", "endDate", D, end_inclusive=True, unit="date")).select(
        "objectId", "beginDate", "endDate")


@register("valid_at_moment", """
SELECT objectId, validFrom, validTo FROM fx_agenda_events
WHERE validFrom <= TIMESTAMP '1998-09-01 12:00:00'
  AND (validTo IS NULL OR validTo >= TIMESTAMP '1998-09-01 12:00:00')""")
def valid_at_moment(t):
    return FL.where(t.agenda_events,
                    T.valid_at("validFrom", "validTo", MOMENT, end_inclusive=True, unit="moment")).select(
        "objectId", "validFrom", "validTo")


@register("open_after_cutoff", """
SELECT objectId, dateEnd FROM fx_care_allocations WHERE dateEnd IS NULL OR dateEnd > DATE '1998-01-01'""")
def open_after_cutoff(t):
    return FL.where(t.care_allocations, T.open_after("dateEnd", "1998")).select("objectId", "dateEnd")


@register("changed_since_prev_month", """
SELECT objectId, updatedAt FROM fx_relations
WHERE updatedAt >= date_trunc('month', DATE '1998-09-15') - INTERVAL 1 MONTH""")
def changed_since_prev_month(t):
    return FL.where(t.relations, T.since_previous_month("updatedAt", dt.date(1998, 9, 15))).select(
        "objectId", "updatedAt")


@register("filter_not_blank", "SELECT objectId, street FROM fx_addresses WHERE NULLIF(TRIM(street), '') IS NOT NULL")
def filter_not_blank(t):
    return FL.where(t.addresses, FL.not_blank("street")).select("objectId", "street")


# -- joins --------------------------------------------------------------------
@register("left_lookup", """
SELECT dt.objectId, p.code AS product_code, ft.id AS finance_id
FROM fx_tariffs dt LEFT JOIN fx_products p ON p.objectId = dt.productObjectId
LEFT JOIN fx_finance_types ft ON ft.objectId = p.financeTypeObjectId""")
def left_lookup(t):
    d, p = t.declaration_tariffs.alias("dt"), t.products.alias("p")
    ft = t.finance_types.alias("ft")
    out = J.lookup(d, p, c("p.objectId") == c("dt.productObjectId"))
    out = J.lookup(out, ft, c("ft.objectId") == c("p.financeTypeObjectId"))
    return out.select(c("dt.objectId").alias("objectId"), c("p.code").alias("product_code"),
                      c("ft.id").alias("finance_id"))


@register("inner_equi", """
SELECT r.objectId, t.name AS relation_type FROM fx_relations r
JOIN fx_relation_types t ON t.objectId = r.clientContactRelationTypeId""")
def inner_equi(t):
    r = t.relations.alias("r")
    ty = t.nexus_client_contact_relation_types.alias("ty")
    return (J.lookup(r, ty, c("ty.objectId") == c("r.clientContactRelationTypeId"), how="inner")
            .select(c("r.objectId").alias("objectId"), c("ty.name").alias("relation_type")))


@register("validity_join_inclusive", """
SELECT msa.objectId, ta.objectId AS team_assignment_id, ta.teamObjectId
FROM fx_shift_assignments msa LEFT JOIN fx_team_assignments ta ON ta.employeeObjectId = msa.employee_id
  AND ta.beginDate <= msa.date AND (ta.endDate IS NULL OR ta.endDate >= msa.date)""")
def validity_join_inclusive(t):
    msa, ta = t.moves_shift_assignments.alias("msa"), t.team_assignments.alias("ta")
    out = T.validity_join(msa, ta, "msa.employee_id", "ta.employeeObjectId", "msa.date",
                          "ta.beginDate", "ta.endDate", end_inclusive=True)
    return out.select(c("msa.objectId").alias("objectId"), c("ta.objectId").alias("team_assignment_id"),
                      c("ta.teamObjectId").alias("teamObjectId"))


@register("validity_join_half_open", """
SELECT msa.objectId, ms.objectId AS shift_id, ms.description
FROM fx_shift_assignments msa LEFT JOIN fx_shifts ms ON ms.timeline_id = msa.timeline_shift_id
  AND ms.valid_from <= msa.date AND (ms.valid_to IS NULL OR ms.valid_to > msa.date)""")
def validity_join_half_open(t):
    msa, ms = t.moves_shift_assignments.alias("msa"), t.moves_shifts.alias("ms")
    out = T.validity_join(msa, ms, "msa.timeline_shift_id", "ms.timeline_id", "msa.date",
                          "ms.valid_from", "ms.valid_to", end_inclusive=False)
    return out.select(c("msa.objectId").alias("objectId"), c("ms.objectId").alias("shift_id"),
                      c("ms.description").alias("description"))


@register("containment_join", """
SELECT la.objectId, cca.objectId AS assignment_id FROM fx_location_assignments la
LEFT JOIN fx_costcenter_assignments cca ON cca.unitObjectId = la.locationObjectId
  AND cca.beginDate <= la.beginDate AND (cca.endDate IS NULL OR cca.endDate >= la.endDate)""")
def containment_join(t):
    la, cca = t.location_assignments.alias("la"), t.costcenter_assignments.alias("cca")
    out = T.containment_join(la, cca, "la.locationObjectId", "cca.unitObjectId",
                             "la.beginDate", "la.endDate", "cca.beginDate", "cca.endDate")
    return out.select(c("la.objectId").alias("objectId"), c("cca.objectId").alias("assignment_id"))


@register("left_join_filtered_right", """
SELECT deg.documentObjectId, deg.expertiseGroupObjectId, eg.name AS group_name
FROM fx_document_groups deg LEFT JOIN fx_expertise_groups eg ON eg.objectId = deg.expertiseGroupObjectId
  AND eg.beginDate <= TIMESTAMP '1998-09-01 00:00:00'
  AND (eg.endDate IS NULL OR eg.endDate > TIMESTAMP '1998-09-01 00:00:00')""")
def left_join_filtered_right(t):
    deg = t.document_expertise_groups.alias("deg")
    eg = FL.where(t.expertise_groups.alias("eg"),
                  T.valid_at("eg.beginDate", "eg.endDate", D, end_inclusive=False, unit="moment"))
    return (J.lookup(deg, eg, c("eg.objectId") == c("deg.expertiseGroupObjectId"))
            .select(c("deg.documentObjectId").alias("documentObjectId"),
                    c("deg.expertiseGroupObjectId").alias("expertiseGroupObjectId"),
                    c("eg.name").alias("group_name")))


@register("anti_join_patterns", """
SELECT cl.objectId, cl.name FROM fx_clients cl
WHERE NOT EXISTS (SELECT 1 FROM fx_relations r JOIN fx_relation_types t ON t.objectId = r.clientContactRelationTypeId
  WHERE r.clientObjectId = cl.objectId AND (t.name ILIKE '%eerste%' OR t.name ILIKE '%tweede%'))""")
def anti_join_patterns(t):
    ty = FL.where(t.nexus_client_contact_relation_types.alias("ty"),
                  FL.like_any("ty.name", "%eerste%,%tweede%"))
    r = t.relations.alias("r")
    related = r.join(ty, c("ty.objectId") == c("r.clientContactRelationTypeId")).select(
        c("r.clientObjectId").alias("_cid"))
    cl = t.clients.select("objectId", "name")
    return J.without_related(cl, related, c("objectId") == c("_cid"))


@register("parent_fallback", """
SELECT mu.objectId,
  CASE WHEN mu.external_id IS NULL THEN concat(mup.code, ' ', mup.name) ELSE concat(mu.code, ' ', mu.name) END AS kostenplaats
FROM fx_units mu LEFT JOIN fx_units mup ON mup.objectId = mu.parent_unit_id""")
def parent_fallback(t):
    mu, mup = t.moves_units.alias("mu"), t.moves_units.alias("mup")
    sp = S.SP
    return (mu.join(mup, c("mup.objectId") == c("mu.parent_unit_id"), "left")
            .select(c("mu.objectId").alias("objectId"),
                    J.parent_fallback(S.concat0("mu.code", sp, "mu.name"), S.concat0("mup.code", sp, "mup.name"),
                                      c("mu.external_id").isNotNull()).alias("kostenplaats")))


@register("multi_bridge_fanout", """
SELECT d.objectId, deg.expertiseGroupObjectId, dr.educationObjectId, dt.tagObjectId
FROM fx_documents d
LEFT JOIN fx_document_groups deg ON deg.documentObjectId = d.objectId
LEFT JOIN fx_document_rights dr ON dr.documentObjectId = d.objectId
LEFT JOIN fx_document_tags dt ON dt.documentObjectId = d.objectId""")
def multi_bridge_fanout(t):
    return J.fan_out(t.documents.select("objectId"), "objectId", [
        (t.document_expertise_groups, "documentObjectId", {"expertiseGroupObjectId": c("expertiseGroupObjectId")}),
        (t.document_rights, "documentObjectId", {"educationObjectId": c("educationObjectId")}),
        (t.document_tags, "documentObjectId", {"tagObjectId": c("tagObjectId")})])


def _trajectory_forms(t):
    j, h = t.cbsbj_jeugdhulps.alias("j"), t.cbsbj_hulpvormen.alias("h")
    return j.join(h, c("h.code") == c("j.hulpvorm"), "left").select(
        c("j.clientObjectId").alias("clientObjectId"), c("h.description").alias("description"))


_FORMS_SQL = """
SELECT j.clientObjectId, string_agg(h.description, ' | ' ORDER BY h.description) AS forms, COUNT(*) AS n_trajectories
FROM fx_youth_trajectories j LEFT JOIN fx_youth_care_forms h ON h.code = j.hulpvorm GROUP BY j.clientObjectId"""


@register("joined_list_and_count", _FORMS_SQL)
def joined_list_and_count(t):
    return A.joined_list(_trajectory_forms(t), ["clientObjectId"], "description", " | ", "forms", "n_trajectories")


@register("attach_child_summary", f"""
WITH s AS ({_FORMS_SQL})
SELECT cl.objectId, coalesce(s.n_trajectories, 0) AS n_trajectories, coalesce(s.forms, '') AS forms
FROM fx_clients cl LEFT JOIN s ON s.clientObjectId = cl.objectId""")
def attach_child_summary(t):
    summary = A.joined_list(_trajectory_forms(t), ["clientObjectId"], "description", " | ",
                            "forms", "n_trajectories").withColumnRenamed("clientObjectId", "_cid")
    out = J.attach_summary(t.clients.select("objectId"), summary, c("_cid") == c("objectId"),
                           {"n_trajectories": 0, "forms": ""})
    return out.select("objectId", "n_trajectories", "forms")


@register("costcentre_chain", """
SELECT la.objectId, cc.identificationNo AS costcentre_no, cc.name AS costcentre_name
FROM fx_location_assignments la
LEFT JOIN fx_costcenter_assignments cca ON cca.unitObjectId = la.locationObjectId
  AND cca.beginDate <= la.beginDate AND (cca.endDate IS NULL OR cca.endDate >= la.endDate)
LEFT JOIN fx_costcenters cc ON cc.objectId = cca.costcenterObjectId
  AND cc.beginDate <= cca.beginDate AND (cc.endDate IS NULL OR cc.endDate >= cca.endDate)
WHERE lower(la.locationType) = 'main'""")
def costcentre_chain(t):
    la = FL.where(t.location_assignments.alias("la"), FL.ci_eq("la.locationType", "main"))
    cca = t.costcenter_assignments.alias("cca")
    cc = t.costcenters.alias("cc")
    out = T.containment_join(la, cca, "la.locationObjectId", "cca.unitObjectId",
                             "la.beginDate", "la.endDate", "cca.beginDate", "cca.endDate")
    out = T.containment_join(out, cc, "cca.costcenterObjectId", "cc.objectId",
                             "cca.beginDate", "cca.endDate", "cc.beginDate", "cc.endDate")
    return out.select(c("la.objectId").alias("objectId"), c("cc.identificationNo").alias("costcentre_no"),
                      c("cc.name").alias("costcentre_name"))


@register("latest_pair_join", """
WITH lc AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY clientObjectId
              ORDER BY coalesce(dateEnd, DATE '9999-12-31') DESC, objectId DESC) AS rn FROM fx_care_allocations),
     ll AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY clientObjectId
              ORDER BY coalesce(endDate, DATE '9999-12-31') DESC, objectId DESC) AS rn
            FROM fx_location_assignments WHERE lower(locationType) = 'main')
SELECT lc.clientObjectId, lc.objectId AS allocation_id, ll.objectId AS assignment_id
FROM lc JOIN ll ON ll.clientObjectId = lc.clientObjectId WHERE lc.rn = 1 AND ll.rn = 1""")
def latest_pair_join(t):
    ca = W.latest_open_per_key(t.care_allocations, ["clientObjectId"], "dateEnd", ["objectId"])
    la = W.latest_open_per_key(FL.where(t.location_assignments, FL.ci_eq("locationType", "main")),
                               ["clientObjectId"], "endDate", ["objectId"])
    return (ca.alias("ca").join(la.alias("la"), c("la.clientObjectId") == c("ca.clientObjectId"))
            .select(c("ca.clientObjectId").alias("clientObjectId"), c("ca.objectId").alias("allocation_id"),
                    c("la.objectId").alias("assignment_id")))


# -- aggregation --------------------------------------------------------------
@register("group_sum", """
SELECT expenseTypeObjectId, CAST(SUM(amount) AS DECIMAL(38,4)) AS amount
FROM fx_expenses GROUP BY expenseTypeObjectId""")
def group_sum(t):
    return A.group_sum(t.expenses, ["expenseTypeObjectId"], "amount", "amount")


@register("group_by_expressions", """
SELECT strftime(createdAt, '%Y%m%d') AS created_day,
  CASE status WHEN 0 THEN 'Nieuw' WHEN 1 THEN 'Concept' WHEN 2 THEN 'Bespreken' WHEN 3 THEN 'Actueel'
              WHEN 4 THEN 'Gearchiveerd' ELSE 'Onbekend' END AS status_label,
  COUNT(*) AS n
FROM fx_survey_results GROUP BY 1, 2""")
def group_by_expressions(t):
    return (t.survey_results.select(S.compact_date("createdAt").alias("created_day"),
                                    S.status_label("status").alias("status_label"))
            .groupBy("created_day", "status_label").agg(F.count(F.lit(1)).alias("n")))


@register("count_distinct_having", """
SELECT i.eventObjectId, COUNT(DISTINCT oc.objectId) AS n_clients
FROM fx_agenda_invitations i JOIN fx_agenda_clients oc ON oc.objectId = i.inviteeObjectId
GROUP BY i.eventObjectId HAVING COUNT(DISTINCT oc.objectId) > 1""")
def count_distinct_having(t):
    i, oc = t.agenda_invitations.alias("i"), t.onsagenda_clients.alias("oc")
    pairs = i.join(oc, c("oc.objectId") == c("i.inviteeObjectId")).select(
        c("i.eventObjectId").alias("eventObjectId"), c("oc.objectId").alias("client"))
    return A.groups_with_many(pairs, "eventObjectId", "client", 1, "n_clients")


def _result_scores(t):
    sr = t.survey_results.select(c("objectId").alias("rid"))
    sa = t.survey_answers.alias("sa")
    sad = t.survey_answer_definitions.alias("sad")
    scored = sa.join(sad, c("sad.objectId") == c("sa.answerDefinitionObjectId"), "left").select(
        c("sa.surveyResultObjectId").alias("_r"), c("sad.score").alias("score"))
    return sr.join(scored, c("_r") == c("rid"), "left").select("rid", "score")


def _date_answers(t):
    sa = t.survey_answers.filter(c("text").isNotNull()).alias("sa")
    sq = t.survey_questions.filter(patterns.like(c("text"), "%Datum%")).select(c("objectId").alias("_q"))
    return sa.join(sq, c("_q") == c("sa.questionObjectId")).select(
        c("sa.surveyResultObjectId").alias("rid"))


_SCORE_SQL = """
SELECT sr.objectId AS rid, CAST(SUM(sad.score) AS BIGINT) AS score
FROM fx_survey_results sr
LEFT JOIN fx_survey_answers sa ON sa.surveyResultObjectId = sr.objectId
LEFT JOIN fx_survey_answer_definitions sad ON sad.objectId = sa.answerDefinitionObjectId
{extra}
GROUP BY sr.objectId"""


@register("fanout_score", _SCORE_SQL.format(extra="""LEFT JOIN (
  SELECT sa2.surveyResultObjectId AS d_rid FROM fx_survey_answers sa2
  JOIN fx_survey_questions sq ON sq.objectId = sa2.questionObjectId
  WHERE sq.text ILIKE '%Datum%' AND sa2.text IS NOT NULL) datum ON datum.d_rid = sr.objectId"""))
def fanout_score(t):
    out = A.sum_over_fanout(_result_scores(t), "rid", "score", [_date_answers(t)], "score")
    return out.select("rid", c("score").cast("bigint").alias("score"))


@register("deduped_score", _SCORE_SQL.format(extra=""))
def deduped_score(t):
    out = A.sum_over_fanout(_result_scores(t), "rid", "score", [], "score")
    return out.select("rid", c("score").cast("bigint").alias("score"))


# -- windows ------------------------------------------------------------------
@register("latest_per_key", """
SELECT careProviderObjectId, objectId, createdAt FROM (
  SELECT cpa.careProviderObjectId, a.objectId, a.createdAt,
    ROW_NUMBER() OVER (PARTITION BY cpa.careProviderObjectId ORDER BY a.createdAt DESC, a.objectId DESC) AS rn
  FROM fx_care_provider_addresses cpa JOIN fx_addresses a ON a.objectId = cpa.addressObjectId) x WHERE rn = 1""")
def latest_per_key(t):
    cpa, a = t.care_provider_addresses.alias("cpa"), t.addresses.alias("a")
    joined = cpa.join(a, c("a.objectId") == c("cpa.addressObjectId")).select(
        "cpa.careProviderObjectId", "a.objectId", "a.createdAt")
    return W.latest_per_key(joined, ["careProviderObjectId"], ["createdAt", "objectId"])


@register("latest_open_per_key", """
SELECT clientObjectId, objectId, dateEnd FROM (
  SELECT clientObjectId, objectId, dateEnd, ROW_NUMBER() OVER (PARTITION BY clientObjectId
    ORDER BY coalesce(dateEnd, DATE '9999-12-31') DESC, objectId DESC) AS rn FROM fx_care_allocations) x WHERE rn = 1""")
def latest_open_per_key(t):
    return W.latest_open_per_key(t.care_allocations.select("clientObjectId", "objectId", "dateEnd"),
                                 ["clientObjectId"], "dateEnd", ["objectId"])


@register("number_within_group", """
SELECT sa.objectId, CAST(ROW_NUMBER() OVER (PARTITION BY sa.surveyResultObjectId
  ORDER BY sq.objectId NULLS FIRST, sa.objectId) AS BIGINT) AS seq
FROM fx_survey_answers sa LEFT JOIN fx_survey_questions sq ON sq.objectId = sa.questionObjectId""")
def number_within_group(t):
    sa, sq = t.survey_answers.alias("sa"), t.survey_questions.alias("sq")
    joined = sa.join(sq, c("sq.objectId") == c("sa.questionObjectId"), "left").select(
        c("sa.objectId").alias("objectId"), c("sa.surveyResultObjectId").alias("rid"),
        c("sq.objectId").alias("qid"))
    out = W.number_within(joined, ["rid"], ["qid", "objectId"], "seq")
    return out.select("objectId", "seq")


# -- scalar functions ---------------------------------------------------------
@register("answer_text", """
SELECT sa.objectId,
  CASE WHEN sq.answertype IN (1,2) AND sa.text IS NULL THEN sad.definition
       WHEN sa.booleanAnswer = 1 THEN 'Ja' ELSE sa.text END AS Antwoord
FROM fx_survey_answers sa
LEFT JOIN fx_survey_questions sq ON sq.objectId = sa.questionObjectId
LEFT JOIN fx_survey_answer_definitions sad ON sad.objectId = sa.answerDefinitionObjectId""")
def answer_text(t):
    sa, sq = t.survey_answers.alias("sa"), t.survey_questions.alias("sq")
    sad = t.survey_answer_definitions.alias("sad")
    out = (sa.join(sq, c("sq.objectId") == c("sa.questionObjectId"), "left")
           .join(sad, c("sad.objectId") == c("sa.answerDefinitionObjectId"), "left"))
    return out.select(c("sa.objectId").alias("objectId"),
                      S.answer_text("sq.answertype", "sa.text", "sad.definition", "sa.booleanAnswer").alias("Antwoord"))


@register("concat_null_as_empty", """
SELECT objectId, concat(identificationNo, ' ', firstName, ' ', name) AS medewerker FROM fx_employees""")
def concat_null_as_empty(t):
    sp = S.SP
    return t.employees.select("objectId", S.concat0("identificationNo", sp, "firstName", sp, "name").alias("medewerker"))


@register("concat_ws_labels", "SELECT objectId, concat_ws(' ', initials, name) AS Clientnaam FROM fx_clients")
def concat_ws_labels(t):
    return t.clients.select("objectId", S.concat_ws_labels(" ", "initials", "name").alias("Clientnaam"))


@register("time_to_minute_text", """
SELECT objectId, left(start_time, 5) AS start_time, left(stop_time, 5) AS stop_time,
  left(start_break_time, 5) AS start_break_time, left(stop_break_time, 5) AS stop_break_time
FROM fx_shift_assignments""")
def time_to_minute_text(t):
    cols = ["start_time", "stop_time", "start_break_time", "stop_break_time"]
    return t.moves_shift_assignments.select("objectId", *[S.time_minute_text(n).alias(n) for n in cols])


_MIN = "date_diff('minute', TIME '00:00:00', CAST({} AS TIME))"


@register("net_shift_hours", f"""
SELECT objectId, CAST(CAST(
  (CASE WHEN stop_time < start_time THEN 1440 - {_MIN.format('start_time')} + {_MIN.format('stop_time')}
        ELSE {_MIN.format('stop_time')} - {_MIN.format('start_time')} END)
  - (CASE WHEN start_break_time IS NULL THEN 0
          WHEN start_break_time > stop_break_time
          THEN {_MIN.format('stop_break_time')} - {_MIN.format('start_break_time')} + 1440
          ELSE {_MIN.format('stop_break_time')} - {_MIN.format('start_break_time')} END) AS DOUBLE) / 60 AS DECIMAL(18,6)) AS dienstduur
FROM fx_shift_assignments""")
def net_shift_hours(t):
    return t.moves_shift_assignments.select("objectId", S.shift_hours(
        "start_time", "stop_time", "start_break_time", "stop_break_time").alias("dienstduur"))


@register("truncate_text", "SELECT objectId, substr(description, 1, 99) AS Toelichting_Titel FROM fx_surveys")
def truncate_text(t):
    return t.surveys.select("objectId", S.truncate_text("description", 99).alias("Toelichting_Titel"))


@register("yes_no_label", """
SELECT objectId, CASE WHEN active = 1 THEN 'Ja' ELSE 'Nee' END AS in_gebruik,
  CASE WHEN useStrictEditAuthorization = 1 THEN 'Ja' ELSE 'Nee' END AS strict_edit,
  CASE WHEN useWorkflow = 1 THEN 'Ja' ELSE 'Nee' END AS workflow FROM fx_surveys""")
def yes_no_label(t):
    return t.surveys.select("objectId", S.yes_no("active").alias("in_gebruik"),
                            S.yes_no("useStrictEditAuthorization").alias("strict_edit"),
                            S.yes_no("useWorkflow").alias("workflow"))


@register("status_label", """
SELECT objectId, CASE status WHEN 0 THEN 'Nieuw' WHEN 1 THEN 'Concept' WHEN 2 THEN 'Bespreken'
  WHEN 3 THEN 'Actueel' WHEN 4 THEN 'Gearchiveerd' ELSE 'Onbekend' END AS Status FROM fx_survey_results""")
def status_label(t):
    return t.survey_results.select("objectId", S.status_label("status").alias("Status"))


@register("date_compact_text", """
SELECT objectId, strftime(createdAt, '%Y%m%d') AS begonnen, strftime(completedAt, '%Y%m%d') AS compleet
FROM fx_survey_results""")
def date_compact_text(t):
    return t.survey_results.select("objectId", S.compact_date("createdAt").alias("begonnen"),
                                   S.compact_date("completedAt").alias("compleet"))


@register("unit_code_map", """
SELECT dt.objectId, CASE lower(u.description)
    WHEN 'dagdeel' THEN 'DAY4HOURS' WHEN 'dag' THEN 'DAY8HOURS' WHEN '12 uren' THEN 'DAY12HOURS'
    WHEN '24 uren' THEN 'DAY24HOURS' WHEN 'uur' THEN 'HOUR' WHEN 'vijf minuten' THEN 'FIVEMINUTE'
    WHEN 'minuut' THEN 'MINUTE' WHEN 'kilometer' THEN 'KILOMETERS' WHEN 'stuk' THEN 'PIECE'
    WHEN 'week' THEN 'WEEK' WHEN 'maand' THEN 'MONTH' WHEN 'periode' THEN 'PERIOD' WHEN 'jaar' THEN 'YEAR'
    WHEN 'half jaar' THEN 'HALFYEAR' WHEN 'kwartaal' THEN 'QUARTER' WHEN 'kwartier' THEN 'FIFTEEN_MINUTES'
    WHEN 'euro' THEN 'EURO' ELSE u.description END AS priceUnit
FROM fx_tariffs dt LEFT JOIN fx_tariff_units u ON u.code = dt.tariffUnit""")
def unit_code_map(t):
    d = t.declaration_tariffs.alias("dt")
    u = t.lst_export_units.alias("u")
    return (J.lookup(d, u, c("u.code") == c("dt.tariffUnit"))
            .select(c("dt.objectId").alias("objectId"), S.unit_code("u.description").alias("priceUnit")))


@register("date_dutch_text", "SELECT objectId, strftime(dateOfBirth, '%d-%m-%Y') AS geboortedatum FROM fx_clients")
def date_dutch_text(t):
    return t.clients.select("objectId", S.dutch_date_text("dateOfBirth").alias("geboortedatum"))


@register("parse_dutch_date", """
SELECT sa.objectId, sa.text,
  strftime(coalesce(try_strptime(sa.text, '%d-%m-%Y'), try_strptime(sa.text, '%d/%m/%Y'),
                    try_strptime(sa.text, '%d.%m.%Y'), try_strptime(sa.text, '%Y-%m-%d')), '%Y%m%d') AS datum
FROM fx_survey_answers sa JOIN fx_survey_questions sq ON sq.objectId = sa.questionObjectId
WHERE sq.text ILIKE '%Datum%' AND sa.text IS NOT NULL""")
def parse_dutch_date(t):
    sa = t.survey_answers.filter(c("text").isNotNull()).alias("sa")
    sq = (t.survey_questions.filter(patterns.like(c("text"), "%Datum%"))
          .select(c("objectId").alias("_q")))
    out = sa.join(sq, c("_q") == c("sa.questionObjectId"))
    return out.select(c("sa.objectId").alias("objectId"), c("sa.text").alias("text"),
                      S.compact_date(S.parse_dutch_date("sa.text")).alias("datum"))


@register("parse_dutch_layouts", """
SELECT objectId, written, CASE WHEN parts THEN make_date(1998, month(d), day(d)) ELSE d END AS parsed FROM fx_written_dates""")
def parse_dutch_layouts(t):
    """Every layout that is accepted, the year taken from the reference date where it is missing."""
    return t.view("fx_written_dates").select("objectId", "written", S.parse_dutch_date("written", D).alias("parsed"))
