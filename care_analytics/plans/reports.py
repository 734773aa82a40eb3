"""The fifteen reports, as DataFrame plans over a :class:`Tables`.

Every report takes its parameters as Python arguments (the source declares
them as SQL variables) and an explicit ``as_of`` wherever the source reads the
clock, so results are reproducible.  Output column names follow the source.
Sorting is applied last and only where the source sorts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from care_analytics.functions import params as P
from care_analytics.functions import patterns
from care_analytics.functions import scalars as S
from care_analytics.operators import aggregates as A
from care_analytics.operators import filters as FL
from care_analytics.operators import joins as J
from care_analytics.operators import temporal as T
from care_analytics.operators import text as TX
from care_analytics.operators import windows as W
from care_analytics.sources.catalog import Tables

c = F.col


# ---------------------------------------------------------------------------
# R01 clients in care on a cost centre without a contact of the given types
# ---------------------------------------------------------------------------
def r01_clients_without_contact(t: Tables, enddate="2025", costcentre="1000-3000",
                                relation="%eerste%,%tweede%") -> DataFrame:
    """Clients with an active care allocation and an open MAIN location on a
    cost centre, without a relation of the given types.

    The source joins every allocation to every location assignment of the
    client and removes the copies with a final GROUP BY.  An allocation only
    contributes "the client has one", so it is a semi join here: same
    result, but a client with many allocations and assignments never forms
    their product.
    """
    ca = FL.where(t.care_allocations, T.open_after("dateEnd", enddate)).select(
        c("clientObjectId").alias("_client"))
    la = FL.where(t.location_assignments, FL.ci_eq("locationType", "MAIN"), c("endDate").isNull()).select(
        c("clientObjectId").alias("_la_client"), c("locationObjectId").alias("_loc"))
    la = J.with_related(la, ca, c("_client") == c("_la_client"))
    cl = t.clients.alias("c")
    cca = t.costcenter_assignments.alias("cca")
    cc = t.costcenters.alias("cc")

    base = (la.join(cl, c("c.objectId") == c("_la_client"), "left")
            .join(cca, c("cca.unitObjectId") == c("_loc"), "left")
            .join(cc, c("cc.objectId") == c("cca.costcenterObjectId"), "left"))
    base = FL.where(base, FL.flex_number("cc.identificationNo", costcentre))
    table_alle = base.select(
        c("_la_client").alias("clientId"),
        c("c.identificationNo").alias("clientNo"),
        c("c.name").alias("clientname"),
        c("cc.identificationNo").alias("costcenterNo"),
        c("cc.name").alias("costcentreName"),
    )

    rel = t.relations.alias("r")
    types = t.nexus_client_contact_relation_types.alias("nccrt")
    types = FL.where(types, FL.like_any("nccrt.name", relation, empty_is_none=True))
    related = (rel.join(types, c("r.clientContactRelationTypeId") == c("nccrt.objectId"))
               .select(c("r.clientObjectId").alias("_cid")))

    out = J.without_related(table_alle, related, c("clientId") == c("_cid"))
    # extra sort keys after the source's only refine its order; they let the
    # range partitioning of the sort split a value shared by many rows
    out = TX.distinct_rows(out)
    return out.orderBy(*TX.in_order(out, "clientId", "costcenterNo", "costcentreName"))


# ---------------------------------------------------------------------------
# R02 rostered shifts with team, expertise, contract and net hours
# ---------------------------------------------------------------------------
def r02_rostered_shifts(t: Tables, start, end) -> DataFrame:
    """Versions that end before or begin after the period never reach a join;
    the employee joins share one list of the days asked for."""
    msa = FL.where(t.moves_shift_assignments.alias("msa"),
                   c("msa.discarded_at").isNull(),
                   FL.in_period("msa.date", start, end))
    mu = t.moves_units.alias("mu")
    mup = t.moves_units.alias("mup")
    ms = t.moves_shifts.alias("ms")
    mep = t.moves_expertise_profiles.alias("mep")
    me = FL.where(t.moves_employees.alias("me"), FL.not_flag("me.dummy", 1))
    e = t.employees.alias("e")
    ta = t.team_assignments.alias("ta")
    tm = t.teams.alias("t")
    epa = t.expertise_profile_assignments.alias("epa")
    ep = t.expertise_profiles.alias("ep")
    co = t.contracts.alias("co")
    ct = t.contract_types.alias("ct")

    at = "msa.date"
    period = (start, end)
    calendar = T.Calendar(period)
    worked = msa.join(me, c("me.objectId") == c("msa.employee_id"), "inner")
    # an employee works on few days, however many shifts there are
    by_employee = {"period": period, "days": T.asked_days(worked, "me.external_id", at, calendar)}
    df = (worked.join(mu, c("mu.objectId") == c("msa.unit_id"), "left")
          .join(mup, c("mup.objectId") == c("mu.parent_unit_id"), "left"))
    # shift version valid on the day; valid_to is the first day of the next version
    df = T.validity_join(df, ms, "msa.timeline_shift_id", "ms.timeline_id", at,
                         "ms.valid_from", "ms.valid_to", end_inclusive=False, period=period,
                         days=T.asked_days(msa, "msa.timeline_shift_id", at, calendar))
    df = df.join(mep, c("mep.objectId") == c("ms.expertise_profile_id"), "left")
    df = df.join(e, c("e.objectId") == c("me.external_id"), "left")
    # back to back: all three key on employee and day
    df = T.validity_join(df, ta, "e.objectId", "ta.employeeObjectId", at,
                         "ta.beginDate", "ta.endDate", end_inclusive=True, **by_employee)
    df = T.validity_join(df, epa, "e.objectId", "epa.employeeObjectId", at,
                         "epa.startTime", "epa.endTime", end_inclusive=True, **by_employee)
    df = T.validity_join(df, co, "e.objectId", "co.employeeObjectId", at,
                         "co.beginDate", "co.endDate", end_inclusive=True, **by_employee)
    df = df.join(tm, c("t.objectId") == c("ta.teamObjectId"), "left")
    df = df.join(ep, c("ep.objectId") == c("epa.expertiseProfileObjectId"), "left")
    df = df.join(ct, c("ct.objectId") == c("co.contractTypeObjectId"), "left")

    sp = S.SP
    own_unit = S.concat0("mu.code", sp, "mu.name")
    return df.select(
        c("msa.objectId").alias("msa_objectid"),
        c("msa.timeline_shift_id").alias("timeline_shift_id"),
        c("ms.description").alias("dienst"),
        c("msa.date").cast("date").alias("datum_dienst"),
        S.concat0("e.identificationNo", sp, "e.firstName", sp, "e.name").alias("medewerker"),
        S.concat0("t.identificationNo", sp, "t.name").alias("team_medewerker"),
        c("ep.description").alias("deskundigheid_medewerker"),
        c("ct.name").alias("contracttype_medewerker"),
        own_unit.alias("planbord"),
        J.parent_fallback(own_unit, S.concat0("mup.code", sp, "mup.name"),
                          c("mu.external_id").isNotNull()).alias("kostenplaats"),
        c("mep.name").alias("deskundigheid_dienst"),
        S.time_minute_text("msa.start_time").alias("start_time"),
        S.time_minute_text("msa.stop_time").alias("stop_time"),
        S.time_minute_text("msa.start_break_time").alias("start_break_time"),
        S.time_minute_text("msa.stop_break_time").alias("stop_break_time"),
        S.shift_hours("msa.start_time", "msa.stop_time", "msa.start_break_time",
                      "msa.stop_break_time").alias("dienstduur"),
    )


# ---------------------------------------------------------------------------
# R03 expense totals per employee x type x cost centre in a period
# ---------------------------------------------------------------------------
def r03_expense_totals(t: Tables, begin, end, expense="%fiets-lease%,%thuis%") -> DataFrame:
    """Note: the cost-centre assignment has no date test in the source, so an
    amount counts once per assignment of its cluster."""
    # Pre-aggregate: the report keys are functions of (employee, type,
    # cluster) and the cost-centre rows, so expenses of the wanted types are
    # summed per (employee, type, cluster) before any join (a hot employee is
    # spread by type and cluster).  The joins then move partial sums, and the
    # cost-centre fan-out multiplies each partial sum as it did each row.
    wanted = FL.like_any("name", expense)
    ex = FL.where(t.expenses, FL.in_period("expenseDate", begin, end))
    if wanted is not None:
        types = t.expense_types.filter(wanted).select(c("objectId").alias("_type"))
        ex = J.with_related(ex, types, c("expenseTypeObjectId") == c("_type"))
    ex = A.group_sum(ex, ["employeeObjectId", "expenseTypeObjectId", "clusterObjectId"], "amount", "amount").alias("exp")
    empl = t.employees.alias("empl")
    et = t.expense_types.alias("et")
    cca = t.costcenter_assignments.alias("cca")
    cc = t.costcenters.alias("cc")
    df = (ex.join(empl, c("empl.objectId") == c("exp.employeeObjectId"), "left")
          .join(et, c("et.objectId") == c("exp.expenseTypeObjectId"), "left")
          .join(cca, c("cca.clusterObjectId") == c("exp.clusterObjectId"), "left")
          .join(cc, c("cca.costcenterObjectId") == c("cc.objectId"), "left"))
    keyed = df.select(
        c("exp.employeeObjectId").alias("employeeId"),
        c("empl.identificationNo").alias("employeeNo"),
        c("empl.contractId").alias("contractNo"),
        c("empl.name").alias("employeeName"),
        c("cc.identificationNo").alias("costscenterNo"),
        c("cc.name").alias("costcenter"),
        c("et.objectId").alias("expenseType"),
        c("et.name").alias("expense"),
        c("exp.amount").alias("amount"),
    )
    keys = ["employeeId", "employeeNo", "contractNo", "employeeName", "costscenterNo",
            "costcenter", "expenseType", "expense"]
    return A.group_sum(keyed, keys, "amount", "amount")


# ---------------------------------------------------------------------------
# R04 one row per filled-in survey with people, cost centres, score, status
# ---------------------------------------------------------------------------
def _answer_summary(t: Tables, restrict_to: DataFrame | None = None) -> DataFrame:
    """Per survey result, in one pass over the answers: the score sum and the
    number of date answers and time answers (the two 1-n answer joins the
    source makes before summing).  ``restrict_to`` (result ids) keeps only
    the answers of selected surveys before aggregating."""
    sa = t.survey_answers
    if restrict_to is not None:
        sa = J.with_related(sa, restrict_to.select(c("objectId").alias("_sel")),
                            c("surveyResultObjectId") == c("_sel"))
    # whether there is a text is all that is moved of it
    sa = sa.select("surveyResultObjectId", "answerDefinitionObjectId", "questionObjectId", c("text").isNotNull().alias("_answered")).alias("sa")
    sad = t.survey_answer_definitions.alias("sad")
    is_date = patterns.like(c("text"), "%Datum%")
    # the source's LIKE on this label has no wildcard: an equality
    is_time = FL.ci_eq("text", "&amp;Tijdstip incident&amp;")
    flagged = (t.survey_questions.select("objectId", "text")
               .filter(is_date | is_time)
               .select(c("objectId").alias("_qid"), is_date.alias("_is_date"), is_time.alias("_is_time")))
    answered = c("sa._answered")
    return (sa.join(sad, c("sad.objectId") == c("sa.answerDefinitionObjectId"), "left")
            .join(flagged, c("_qid") == c("sa.questionObjectId"), "left")
            .groupBy(c("sa.surveyResultObjectId").alias("_rid"))
            .agg(F.sum("sad.score").alias("_score"),
                 F.count(F.when(answered & c("_is_date"), 1)).alias("_n_date"),
                 F.count(F.when(answered & c("_is_time"), 1)).alias("_n_time")))


def _costcentre_labels(t: Tables) -> DataFrame:
    """Cost centres with the id (``_label``) of the first one of the same number
    and name; none where both are missing."""
    alike = Window.partitionBy(TX.as_text("identificationNo"), TX.as_text("name"))
    label = F.when(c("identificationNo").isNotNull() | c("name").isNotNull(), F.min("objectId").over(alike))
    return t.costcenters.withColumn("_label", label)


def _costcentre_chain(t: Tables, assignments: DataFrame, key: str, unit: str, link: str) -> DataFrame:
    """The cost centres of each assignment interval of a person (one row without
    any): master data, found before any survey."""
    cca = t.costcenter_assignments.alias("cca")
    cc = _costcentre_labels(t).alias("cc")
    # a unit has one cost centre at a time and a cost centre is one row: lookups,
    # with containment as a further test
    within = "{o}.beginDate <= {i}.beginDate AND ({o}.endDate IS NULL OR {o}.endDate >= {i}.endDate)"
    df = J.lookup(assignments.alias("own"), cca, F.expr(f"cca.{link} = own.{unit} AND {within.format(o='cca', i='own')}"))
    df = J.lookup(df, cc, F.expr(f"cc.objectId = cca.costcenterObjectId AND {within.format(o='cc', i='cca')}"))
    return df.select(c(f"own.{key}").alias("_person"), c("own.beginDate").alias("_from"), c("own.endDate").alias("_to"), "_label")


def _costcentres_at(results: DataFrame, person: str, chain: DataFrame, end_inclusive: bool, side: str) -> DataFrame:
    """Per (person, moment) at which surveys were filled in: the cost centres with
    their number, as one list, so that results are joined without being multiplied."""
    found = T.versions_at(results, chain, person, "_person", "_moment", "_from", "_to", end_inclusive)
    # counted per block first, where the versions were found; a list has one entry a cost
    # centre and block, at most one a level
    counted = found.groupBy("_valid_key", "_valid_block", "_valid_at", "_label").agg(F.count(F.lit(1)).alias("_n"))
    lists = (counted.groupBy(c("_valid_key").alias(f"_{side}_who"), c("_valid_at").alias(f"_{side}_at"))
             .agg(F.collect_list(F.struct("_label", "_n")).alias("_all")))
    return lists.select(f"_{side}_who", f"_{side}_at", F.expr(
        "transform(array_distinct(transform(_all, x -> x._label)), l -> named_struct("
        f"'_{side}_label', l, '_n_{side}', aggregate(filter(_all, x -> x._label <=> l), 0L, (n, x) -> n + x._n)))").alias(f"_{side}_centres"))


def r04_survey_overview(t: Tables, vragenlijst="%1.2%", dedupe: bool = False) -> DataFrame:
    """One row per filled-in survey (and per cost-centre label pair).

    ``TotaalScore`` reproduces the source: the answer scores are summed over
    the product of every 1-n join (team chain, location chain, date and time
    answers), so a second date answer doubles the score.  The product is not
    materialised: each branch is counted per survey result and the counts
    are multiplied.  ``dedupe=True`` gives the plain score sum instead.
    """
    title = FL.like_any("title", vragenlijst, trim=True)
    s = FL.where(t.surveys, title).alias("s")
    ta = t.team_assignments.select("employeeObjectId", "teamObjectId", "beginDate", "endDate")
    la = FL.where(t.location_assignments, FL.ci_eq("locationType", "main")).select(
        "clientObjectId", "locationObjectId", "beginDate", "endDate")
    # against dates a moment only counts as midnight or later in the day
    dated = all(isinstance(f.dataType, DateType) for x in (ta, la) for f in x.schema if f.name in ("beginDate", "endDate"))
    moment = F.expr(T.half_day("createdAt") if dated else "createdAt").alias("_moment")
    # results travel as keys, moments and status; texts come once all else is found
    sr = t.survey_results.select("objectId", "surveyObjectId", "clientObjectId", "employeeObjectId", "createdAt", "completedAt", "status", moment)
    if title is not None:
        sr = J.with_related(sr.alias("all"), s.select(c("objectId").alias("_sel")), c("surveyObjectId") == c("_sel"))
    results = sr.alias("sr")

    answers = _answer_summary(t, restrict_to=results if title is not None else None)
    # the chains hang on the assignments alone; surveys only look up their date
    emp_cc = _costcentres_at(results, "employeeObjectId", _costcentre_chain(
        t, ta, "employeeObjectId", "teamObjectId", "clusterObjectId"), True, "m")
    cli_cc = _costcentres_at(results, "clientObjectId", _costcentre_chain(
        t, la, "clientObjectId", "locationObjectId", "unitObjectId"), False, "c")
    # names come after the counts
    labels = _costcentre_labels(t).groupBy("_label").agg(
        F.min("identificationNo").alias("_no"), F.min("name").alias("_name")).filter(c("_label").isNotNull())

    # every branch is aggregated first: answers per result, cost centres per
    # person and moment; people and texts are looked up once per result, the longest
    # last, and only then has a result a row per pair of cost centres
    df = (results.join(answers, c("sr.objectId") == answers["_rid"], "left").drop("_rid")
          .join(emp_cc, (c("sr.employeeObjectId") == c("_m_who")) & (c("_moment") == c("_m_at")), "left")
          .join(cli_cc, (c("sr.clientObjectId") == c("_c_who")) & (c("_moment") == c("_c_at")), "left")
          .join(t.employees.alias("e"), c("e.objectId") == c("sr.employeeObjectId"), "left")
          .join(t.clients.alias("cl"), c("cl.objectId") == c("sr.clientObjectId"), "left")
          .join(s, c("s.objectId") == c("sr.surveyObjectId"), "left" if title is None else "inner")
          .select("*", F.inline_outer("_m_centres")).select("*", F.inline_outer("_c_centres"))
          .join(labels.alias("ccm"), c("ccm._label") == c("_m_label"), "left")
          .join(labels.alias("ccc"), c("ccc._label") == c("_c_label"), "left"))

    total = c("_score") if dedupe else c("_score") * A.fan_factor(["_n_date", "_n_time", "_n_m", "_n_c"])
    filled = F.coalesce(c("sr.completedAt"), c("sr.createdAt"))
    return df.select(
        c("sr.objectId").alias("Ingevulde_Vragenlijst"),
        c("cl.objectId").alias("ClientID"),
        c("cl.identificationNo").alias("Clientnummer"),
        S.concat_ws_labels(" ", "cl.initials", "cl.name").alias("Clientnaam"),
        c("e.objectId").alias("MedewerkerID"),
        c("e.identificationNo").alias("Medewerkernummer"),
        S.concat_ws_labels(" ", "e.initials", "e.name").alias("Medewerkernaam"),
        S.concat_ws_labels(" ", "ccm._no", "ccm._name").alias("Kostenplaats_Mdw"),
        S.concat_ws_labels(" ", "ccc._no", "ccc._name").alias("Kostenplaats_Client"),
        S.compact_date(filled).alias("Ingevuld_datum"),
        S.compact_date(filled).alias("Antwoord_datum"),
        F.when(c("sr.completedAt").isNull(), F.lit("0")).otherwise(F.lit("1")).alias("VragenlijstVoltooid"),
        c("s.title").alias("Vragenlijst"),
        S.truncate_text("s.description", 99).alias("Toelichting_Titel"),
        total.alias("TotaalScore"),
        S.yes_no("s.active").alias("Vragenlijst_In_Gebruik"),
        S.yes_no("s.useStrictEditAuthorization").alias("DeskundigheidRelevantVoorGebruik"),
        S.yes_no("s.useWorkflow").alias("BevatProcesstapBespreken"),
        S.compact_date("sr.createdAt").alias("InvullenBegonnenOp"),
        S.compact_date("sr.completedAt").alias("InvullenCompleetOp"),
        S.status_label("sr.status").alias("Status"),
    )


# ---------------------------------------------------------------------------
# R05 questions and answers of filled-in surveys, numbered per survey
# ---------------------------------------------------------------------------
def r05_survey_answers(t: Tables, vragenlijst="") -> DataFrame:
    """The id filter applies to the filled-in survey (result) id; '' and NULL
    mean no filter; spaces are removed and empty tokens dropped.  Numbering
    happens after the filters, as the SQL evaluation order implies."""
    sr = t.survey_results.select(c("objectId").alias("_rid"))
    sa = t.survey_answers.alias("sa")
    sad = t.survey_answer_definitions.alias("sad")
    sq = t.survey_questions.alias("sq")
    ids = FL.in_tokens("sa.surveyResultObjectId", vragenlijst, numeric=True)
    sa = FL.where(sa, ids)
    df = (J.with_related(sa, sr, c("sa.surveyResultObjectId") == c("_rid"))
          .join(sad, c("sad.objectId") == c("sa.answerDefinitionObjectId"), "left")
          .join(sq, c("sq.objectId") == c("sa.questionObjectId"), "left"))
    answer = S.answer_text("sq.answertype", "sa.text", "sad.definition", "sa.booleanAnswer")
    df = df.withColumn("_answer", answer).filter(c("_answer").isNotNull()).select(
        c("sa.surveyResultObjectId").alias("_rid"),
        c("sq.objectId").alias("_qid"),
        c("sa.objectId").alias("_aid"),
        c("sq.text").alias("Vraag"),
        c("sq.additionalInfo").alias("Aanvullende_Info_Bij_Vraag"),
        c("_answer").alias("Antwoord"),
        S.answer_kind("sq.answertype").alias("Antwoord_Type"),
        c("sad.score").alias("Score_Meerkeuze"),
    )
    # a survey result, or a question of it, with a large share of all answers is split
    df = W.number_within(df, ["_rid"], ["_qid", "_aid"], "_seq")
    return df.select(
        c("_rid").cast("string").alias("Ingevulde_Vragenlijst"),
        c("_seq").alias("Sorteervolgorde_Vraag"),
        "Vraag", "Aanvullende_Info_Bij_Vraag", "Antwoord", "Antwoord_Type", "Score_Meerkeuze",
        F.lit(S.ANSWER_SOURCE).alias("Bron"),
    )


# ---------------------------------------------------------------------------
# R06 still-active appointments with more than one client, with location
# ---------------------------------------------------------------------------
def r06_multi_client_events(t: Tables, as_of) -> DataFrame:
    """Follows the source code: events without a location stay (LEFT JOIN),
    and an event with several locations gives several rows."""
    ev = FL.where(t.agenda_events.alias("e"),
                  T.end_after("e.validTo", P.parse_moment(as_of), end_inclusive=True))
    # only invitations of still-active events, resolved in one pass; the test is said
    # once more as a plain comparison, which Spark takes as a sign to filter the
    # invitations at their scan by a Bloom filter of the active events
    active = ev.filter(F.coalesce(c("e.validTo"), T.lit_moment(dt.datetime(9999, 12, 31))) >= T.lit_moment(P.parse_moment(as_of)))
    inv = J.with_related(t.agenda_invitations.select("eventObjectId", "inviteeObjectId"),
                         active.select(c("e.objectId").alias("_active")), c("eventObjectId") == c("_active"))
    ol, oc = t.onsagenda_locations, t.onsagenda_clients
    invited = J.polymorphic_bridge(inv, "inviteeObjectId", [
        ("location", ol, "objectId", {"external": ol["externalObjectId"]}), ("client", oc, "objectId", {})])
    per_event = (invited.groupBy(c("eventObjectId").alias("_ev"))
                 .agg(F.countDistinct(F.when(c("invitee_kind") == "client", c("inviteeObjectId"))).alias("aantal_clienten"),
                      F.collect_set(F.when(c("invitee_kind") == "location", F.struct("external"))).alias("_places"))
                 .filter(c("aantal_clienten") > 1)
                 .select("_ev", "aantal_clienten", F.explode_outer("_places").alias("_place"))
                 .withColumn("locationExternalObjectId", c("_place.external")))
    loc = t.locations.alias("l")
    df = (ev.join(per_event, c("_ev") == c("e.objectId"))
          .join(loc, c("l.objectId") == c("locationExternalObjectId"), "left"))
    return (df.select(
        c("e.objectId").alias("eventObjectId"),
        c("locationExternalObjectId").alias("locationObjectId"),
        c("l.name").alias("locatie"),
        c("e.name").alias("afspraaktitel"),
        c("e.comment").alias("commentaar"),
        c("e.createdAt").alias("afspraak_aangemaakt"),
        c("e.validFrom").alias("afspraak_start"),
        c("e.validTo").alias("afspraak_einde"),
        c("e.clientPresent").alias("client_aanwezig"),
        c("aantal_clienten").cast("bigint").alias("aantal_clienten"),
    ).orderBy("afspraak_start", "eventObjectId", "locationObjectId"))


# ---------------------------------------------------------------------------
# R07 pharmacies with their newest valid address
# ---------------------------------------------------------------------------
def r07_pharmacies_latest_address(t: Tables, as_of, category="Apothekers") -> DataFrame:
    cp = t.care_providers.alias("cp")
    cpc = FL.where(t.care_provider_categories.alias("cpc"), FL.ci_eq("cpc.name", category))
    cp = cp.join(cpc, c("cpc.objectId") == c("cp.organisationCategoryId"))
    # only pharmacies' addresses are ranked
    cpa = J.with_related(t.care_provider_addresses.alias("cpa"), cp.select(c("cp.objectId").alias("_cp")),
                         c("cpa.careProviderObjectId") == c("_cp"))
    a = t.addresses.alias("a")
    addr = FL.where(a, FL.not_blank("a.street"),
                    T.valid_at("a.beginDate", "a.endDate", as_of, end_inclusive=True, unit="moment"))
    addr = cpa.join(addr, c("a.objectId") == c("cpa.addressObjectId")).select(
        c("cpa.careProviderObjectId").alias("_provider"), c("a.createdAt").alias("_created"), c("a.objectId").alias("_address"),
        *[f"a.{n}" for n in ("street", "homeNumber", "homeNumberExtension", "zipcode", "city", "telephoneNumber", "email")])
    addr = W.latest_per_key(addr, ["_provider"], ["_created", "_address"]).alias("a")
    df = cp.join(addr, c("a._provider") == c("cp.objectId"), "left")
    return df.select(
        c("cp.fullName").alias("naam"),
        c("a.street").alias("straatnaam"),
        c("a.homeNumber").alias("huisnummer"),
        c("a.homeNumberExtension").alias("huisnummer_toevoeging"),
        c("a.zipcode").alias("postcode"),
        c("a.city").alias("gemeente"),
        c("a.telephoneNumber").alias("telefoonnummer"),
        c("a.email").alias("email"),
    )


# ---------------------------------------------------------------------------
# R08 guardians created or changed since the start of last month
# ---------------------------------------------------------------------------
def r08_recent_guardians(t: Tables, as_of, relation_type="Bewindvoerder") -> DataFrame:
    r = FL.where(t.relations.alias("r"), T.since_previous_month("r.updatedAt", as_of))
    cl = t.clients.alias("c")
    lst = FL.where(t.lst_wlz_cod472s.alias("lst"), FL.ci_eq("lst.description", relation_type))
    df = (r.join(lst, J.text_key("lst.code") == J.text_key("r.type"))
          .join(cl, c("c.objectId") == c("r.clientObjectId"), "left"))
    # sorted on the source columns (the relation id splits a busy day)
    return df.orderBy(c("r.updatedAt"), c("r.objectId")).select(
        c("r.clientObjectId").alias("clientObjectId"),
        c("c.identificationNo").alias("identificationNo"),
        c("lst.description").alias("relationType"),
        *[c(f"r.{n}").alias(n) for n in ("firstName", "birthName", "initials", "birthNamePrefix",
                                          "name", "prefix", "organization", "comments",
                                          "createdAt", "updatedAt")],
    )


# ---------------------------------------------------------------------------
# R09 current locations of living clients in care
# ---------------------------------------------------------------------------
def r09_current_locations(t: Tables, as_of) -> DataFrame:
    """Care allocation valid at the moment (end exclusive); location
    assignment and location valid on the date (end inclusive)."""
    cl = FL.where(t.clients.alias("c"), c("c.deathDate").isNull())
    ca = FL.where(t.care_allocations.alias("ca"),
                  T.valid_at("ca.dateBegin", "ca.dateEnd", as_of, end_inclusive=False, unit="moment"))
    la = FL.where(t.location_assignments.alias("la"),
                  T.valid_at("la.beginDate", "la.endDate", as_of, end_inclusive=True, unit="date"))
    loc = FL.where(t.locations.alias("l"),
                   T.valid_at("l.beginDate", "l.endDate", as_of, end_inclusive=True, unit="date"))
    df = (cl.join(ca, c("ca.clientObjectId") == c("c.objectId"))
          .join(la, c("la.clientObjectId") == c("c.objectId"))
          .join(loc, c("l.objectId") == c("la.locationObjectId")))
    df = df.select(
        c("c.objectId").alias("client_id"),
        c("c.identificationNo").alias("clientnummer"),
        c("c.givenName").alias("roepnaam"),
        c("c.firstName").alias("voornaam"),
        c("c.lastName").alias("achternaam"),
        c("c.dateOfBirth").alias("geboortedatum"),
        c("l.objectId").alias("locatie_id"),
        c("l.name").alias("locatie_naam"),
        c("l.identificationNo").alias("locatie_nummer"),
        c("l.intramuralLocation").alias("intramuraal"),
        c("la.locationType").alias("toekenning_type"),
        c("la.residence").alias("verblijfslocatie"),
        c("la.beginDate").alias("locatie_begin"),
        c("la.endDate").alias("locatie_eind"),
        c("ca.dateBegin").alias("zorg_begin"),
        c("ca.dateEnd").alias("zorg_eind"),
    )
    return df.orderBy(*TX.in_order(df, "locatie_naam", "achternaam", "voornaam", "client_id", "locatie_id",
                                   "zorg_begin", "locatie_begin"))


# ---------------------------------------------------------------------------
# R10 youth-act clients in a period with product and trajectory lists
# ---------------------------------------------------------------------------
def r10_youth_act_clients(t: Tables, start, end, legitimation="%JW%") -> DataFrame:
    """The product list counts all entitlements of the client in the period,
    not only youth-act ones, and keeps duplicates (as the source)."""
    leg = t.legitimaties

    def in_period(df, prefix=""):
        return FL.where(
            df,
            T.overlaps(f"{prefix}van", f"{prefix}tot", start, end, end_inclusive=False),
            T.overlaps(f"{prefix}product_van", f"{prefix}product_tot", start, end, end_inclusive=False),
        )

    # The output is DISTINCT over a few columns of each side, so each side is
    # reduced to distinct values of those columns before the per-client join.
    lg = (in_period(leg, "").filter(patterns.like(c("legitimatie"), legitimation))
          .select("clientno", "clientObjectId", "client", "geboren", "legitimatie"))
    lg = TX.distinct_rows(lg).alias("l")
    ca = (FL.where(t.care_allocations, T.overlaps("dateBegin", "dateEnd", start, end, end_inclusive=False))
          .select("clientObjectId", "dateBegin", "dateEnd").distinct().alias("ca"))
    # lists are built for the reported clients only
    reported = J.with_related(lg, ca, c("ca.clientObjectId") == c("l.clientObjectId")).select(c("l.clientObjectId").alias("_reported"))
    own = J.with_related(in_period(leg.filter(c("product").isNotNull())), reported, c("clientObjectId") == c("_reported"))
    products = A.joined_list(own.select(c("clientObjectId").alias("_pc"), "product"),
                             ["_pc"], "product", " | ", "producten", "aantal_producten")

    j = FL.where(t.cbsbj_jeugdhulps.alias("j"),
                 T.overlaps("j.datumAanvang", "j.datumBeeindiging", start, end, end_inclusive=True))
    j = J.with_related(j, reported, c("j.clientObjectId") == c("_reported"))
    h = t.cbsbj_hulpvormen.alias("h")
    traj = (j.join(h, J.text_key("h.code") == J.text_key("j.hulpvorm"), "left")
            .select(c("j.clientObjectId").alias("_tc"), c("h.description").alias("description")))
    trajectories = A.joined_list(traj, ["_tc"], "description", " | ",
                                 "actieve_jeugdtrajecten", "aantal_actieve_jeugdtrajecten")

    df = lg.join(ca, c("ca.clientObjectId") == c("l.clientObjectId"))
    df = J.attach_summary(df, products, c("_pc") == c("l.clientObjectId"),
                          {"aantal_producten": 0, "producten": ""})
    df = J.attach_summary(df, trajectories, c("_tc") == c("l.clientObjectId"),
                          {"aantal_actieve_jeugdtrajecten": 0, "actieve_jeugdtrajecten": ""})
    df = df.select(
        c("l.clientno").alias("clientno"),
        c("l.clientObjectId").alias("clientObjectId"),
        c("l.client").alias("client"),
        S.dutch_date_text("l.geboren").alias("geboortedatum"),
        F.coalesce(S.dutch_date_text("ca.dateBegin"), F.lit("")).alias("startdatum_in_zorg"),
        F.coalesce(S.dutch_date_text("ca.dateEnd"), F.lit("")).alias("einddatum_in_zorg"),
        c("l.legitimatie").alias("legitimatie"),
        c("aantal_producten").cast("bigint").alias("aantal_producten"),
        c("producten"),
        c("aantal_actieve_jeugdtrajecten").cast("bigint").alias("aantal_actieve_jeugdtrajecten"),
        c("actieve_jeugdtrajecten"),
    )
    out = TX.distinct_rows(df)
    return out.orderBy(*TX.in_order(out, "client", "clientObjectId", "startdatum_in_zorg", "einddatum_in_zorg"))


# ---------------------------------------------------------------------------
# R11 youth trajectories with a given referrer in a period
# ---------------------------------------------------------------------------
def r11_trajectories_by_referrer(t: Tables, start, end, verwijzer="Geen verwijzer") -> DataFrame:
    j = FL.where(t.cbsbj_jeugdhulps.alias("j"),
                 T.overlaps("j.datumAanvang", "j.datumBeeindiging", start, end, end_inclusive=True))
    h = t.cbsbj_hulpvormen.alias("h")
    v = FL.where(t.cbsbj_verwijzers.alias("v"), FL.ci_eq("v.description", verwijzer))
    cl = t.clients.alias("c")
    df = (j.join(v, J.text_key("v.code") == J.text_key("j.verwijzer"))
          .join(h, J.text_key("h.code") == J.text_key("j.hulpvorm"), "left")
          .join(cl, c("c.objectId") == c("j.clientObjectId"), "left"))
    return df.select(
        c("j.clientObjectId").alias("clientObjectId"),
        c("c.identificationNo").alias("clientnummer"),
        c("h.description").alias("hulpvorm"),
        c("v.description").alias("verwijzer"),
        c("j.datumAanvang").alias("datumAanvang"),
        c("j.datumBeeindiging").alias("datumBeeindiging"),
    )


# ---------------------------------------------------------------------------
# R12 clients out of care whose main location is still open
# ---------------------------------------------------------------------------
def r12_open_location_after_care(t: Tables, eind, begin="2000-01-01", locatie="Wachtlijst") -> DataFrame:
    """NULL or ``''`` for ``begin``, ``eind`` or ``locatie`` filters nothing (the
    documented contract); a NULL location name is never excluded."""
    ca = FL.where(t.care_allocations,
                  T.overlaps("dateBegin", "dateEnd", begin, eind, end_inclusive=True))
    ca = W.latest_open_per_key(ca.select("clientObjectId", "objectId", "dateBegin", "dateEnd"),
                               ["clientObjectId"], "dateEnd", ["objectId"]).alias("ca")
    la = FL.where(t.location_assignments,
                  T.overlaps("beginDate", "endDate", begin, eind, end_inclusive=True),
                  FL.ci_eq("locationType", "MAIN"),
                  # an open end ranks first and only open ones are reported, so
                  # ended ones go at the scan (the last day ties with open)
                  c("endDate").isNull() | (c("endDate") >= F.lit(W.LAST_DAY).cast("date")))
    la = W.latest_open_per_key(la.select("clientObjectId", "objectId", "locationObjectId", "beginDate", "endDate"),
                               ["clientObjectId"], "endDate", ["objectId"]).alias("la")
    cl = t.clients.alias("c")
    loc = t.locations.alias("l")
    df = (ca.join(la, c("la.clientObjectId") == c("ca.clientObjectId"))
          .join(cl, c("c.objectId") == c("ca.clientObjectId"), "left")
          .join(loc, c("l.objectId") == c("la.locationObjectId"), "left"))
    df = FL.where(df, c("ca.dateEnd").isNotNull(), c("la.endDate").isNull(),
                  FL.contains_none("l.name", locatie))
    return df.orderBy(c("ca.dateEnd").asc(), c("ca.clientObjectId")).select(
        c("ca.clientObjectId").alias("clientId"),
        c("c.identificationNo").alias("client_nummer"),
        c("c.name").alias("name"),
        c("c.dateOfBirth").alias("geboortedatum"),
        c("c.deathDate").alias("overlijdensdatum"),
        c("ca.dateBegin").cast("date").alias("legitimatie_begin"),
        c("ca.dateEnd").cast("date").alias("legitimatie_eind"),
        c("l.name").alias("locatie"),
        c("la.beginDate").cast("date").alias("locatie_begin"),
        c("la.endDate").cast("date").alias("locatie_eind"),
    )


# ---------------------------------------------------------------------------
# R13 tariff export with unit mapping
# ---------------------------------------------------------------------------
def r13_tariff_export(t: Tables) -> DataFrame:
    dt_ = t.declaration_tariffs.alias("dt")
    p = t.products.alias("p")
    ft = t.finance_types.alias("ft")
    eu = t.lst_export_units.alias("eu")
    d = t.debtors.alias("d")
    ldt = t.lst_debtor_types.alias("ldt")
    u = t.uzovis.alias("u")
    df = (dt_.join(p, c("p.objectId") == c("dt.productObjectId"), "left")
          .join(ft, c("ft.objectId") == c("p.financeTypeObjectId"), "left")
          .join(eu, J.text_key("eu.code") == J.text_key("dt.tariffUnit"), "left")
          .join(d, c("d.objectId") == c("dt.debtorObjectId"), "left")
          .join(ldt, J.text_key("ldt.code") == J.text_key("d.type"), "left")
          .join(u, c("u.objectId") == c("d.uzoviObjectId"), "left"))
    return df.select(
        c("ft.id").alias("Importcode legitimatie"),
        c("p.code").alias("productCode of importcode"),
        c("p.vektiscode").alias("vektiscode"),
        c("ldt.description").alias("debtorType"),
        c("u.code").alias("debtorUzoviCode"),
        c("d.debtorNumber").alias("debiteurnummer"),
        c("dt.careProviderCode").alias("agbCode"),
        c("dt.tariffValue").alias("priceInCents"),
        S.unit_code("eu.description").alias("priceUnit"),
        c("dt.beginDate").alias("begindatum"),
        c("dt.endDate").alias("eindDatum"),
    )


# ---------------------------------------------------------------------------
# R14 confidential documents with groups, profiles and tags
# ---------------------------------------------------------------------------
def r14_confidential_documents(t: Tables, as_of) -> DataFrame:
    """One row per combination of group, profile and tag of a document (the
    source's 1-n joins are kept as they are)."""
    d = t.documents.filter(c("confidential") == 1).alias("d")
    deg = t.document_expertise_groups.alias("deg")
    eg = FL.where(t.expertise_groups.alias("eg"),
                  T.valid_at("eg.beginDate", "eg.endDate", as_of, end_inclusive=False, unit="moment"))
    dr = t.document_rights.alias("dr")
    ep = t.expertise_profiles.alias("ep")
    dtg = t.document_tags.alias("dtg")
    tg = t.tags.alias("tg")
    st = t.lst_document_statuses.alias("st")
    cl = t.clients.alias("c")
    df = (d.join(st, J.text_key("st.code") == J.text_key("d.status"), "left")
          .join(cl, c("c.objectId") == c("d.clientObjectId"), "left"))
    # names are looked up per bridge row, before the product
    df = J.fan_out(df, "d.objectId", [
        (deg.join(eg, c("eg.objectId") == c("deg.expertiseGroupObjectId"), "left"), "deg.documentObjectId",
         {"deskundigheidsgroep": c("eg.name")}),
        (dr.join(ep, c("ep.objectId") == c("dr.educationObjectId"), "left"), "dr.documentObjectId",
         {"deskundigheidsprofiel": c("ep.description"), "deskundigheidsprofiel_zichtbaar": c("ep.visible")}),
        (dtg.join(tg, c("tg.objectId") == c("dtg.tagObjectId"), "left"), "dtg.documentObjectId",
         {"document_label": c("tg.name")}),
    ])
    return df.select(
        c("d.objectId").alias("objectId"),
        c("d.employeeObjectId").alias("employeeObjectId"),
        c("d.description").alias("document_beschrijving"),
        c("d.filename").alias("document_naam"),
        c("st.description").alias("status"),
        c("d.clientObjectId").alias("clientObjectId"),
        c("c.identificationNo").alias("clientnummer"),
        c("d.message").alias("melding"),
        c("d.confidential").alias("vertrouwelijk"),
        c("d.createdAt").alias("aangemaakt_op"),
        c("d.updatedAt").alias("bewerkt_op"),
        "deskundigheidsgroep", "deskundigheidsprofiel", "deskundigheidsprofiel_zichtbaar", "document_label",
    )


# ---------------------------------------------------------------------------
# R15 presence logs (written hours) in a period
# ---------------------------------------------------------------------------
def r15_presence_logs(t: Tables, start, end) -> DataFrame:
    """A timestamp compared with a date parameter means midnight of that day."""
    pl = FL.where(t.presence_logs.alias("pl"),
                  T.overlaps("pl.startDate", "pl.endDate", start, end, end_inclusive=True))
    e = t.employees.alias("e")
    tm = t.teams.alias("t")
    lpt = t.lst_pool_types.alias("lpt")
    a = t.activities.alias("a")
    df = (pl.join(e, c("e.objectId") == c("pl.employeeId"), "left")
          .join(tm, c("t.objectId") == c("pl.costClusterObjectId"), "left")
          .join(lpt, J.text_key("lpt.code") == J.text_key("t.poolcluster"), "left")
          .join(a, c("pl.activityObjectId") == c("a.objectId"), "left"))
    return df.select(
        c("pl.startDate").alias("startdatum"),
        c("pl.endDate").alias("einddatum"),
        c("e.identificationNo").alias("medewerkernummer"),
        F.trim(S.concat0("e.lastName", S.Text(", "), "e.initials", S.SP, "e.prefix")).alias("employee_name"),
        c("a.description").alias("uursoort_beschrijving"),
        c("a.identificationNo").alias("uursoort_code"),
        c("t.identificationNo").alias("kostenplaatsnummer"),
        c("t.name").alias("kostenplaats_naam"),
        c("lpt.description").alias("pool_type"),
        c("pl.clientId").alias("client_id"),
        c("pl.removed").alias("is_verwijderd"),
        c("pl.registration").alias("is_urenregistratie"),
        c("pl.payment").alias("is_voor_verloning"),
        c("pl.verified").alias("is_gefiatteerd"),
        c("pl.verifiedDate").alias("fiatteringsdatum"),
    )


# ---------------------------------------------------------------------------
# Template: select, filter on a non-NULL column, sort
# ---------------------------------------------------------------------------
def starter_query(df: DataFrame, first: str, second: str) -> DataFrame:
    out = df.filter(c(first).isNotNull()).select(c(first).alias("kolom_1"), c(second).alias("kolom_2"))
    return out.orderBy(*TX.in_order(out, "kolom_1", "kolom_2"))
