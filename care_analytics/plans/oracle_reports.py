"""DuckDB SQL for each report, from the meaning of the report and not from its plan.

Each oracle takes its own way: sets of client ids, validity by listing the days
of a version, "no later row exists" for the newest row, counting earlier rows
for a running number, explicit products before a sum.  The functions take the
report's parameters as SQL; the constants are the registered ones.  The ``fx_*``
adapters are put in front by :func:`care_analytics.sources.fixtures.oracle_prefix`.
"""

from care_analytics.functions.scalars import STATUS_LABELS, STATUS_UNKNOWN, UNIT_CODES

# Fixed values as tables.
STATUS_ROWS = ", ".join(f"({code}, '{label}')" for code, label in STATUS_LABELS.items())
UNIT_ROWS = ", ".join(f"('{name}', '{code}')" for name, code in UNIT_CODES.items())


def r01(cutoff: str | None = "DATE '1998-09-01'", costcentre: str = "TRY_CAST(no AS INTEGER) BETWEEN 1000 AND 3000",
        types: str = "name ILIKE '%eerste%' OR name ILIKE '%tweede%'") -> str:
    ended = f"dateEnd <= {cutoff}" if cutoff else "FALSE"
    return f"""
WITH home AS (SELECT clientObjectId AS id, locationObjectId AS place FROM fx_location_assignments
              WHERE upper(locationType) = 'MAIN' AND endDate IS NULL),
centre AS (SELECT unitObjectId AS place, k.identificationNo AS no, k.name AS label
           FROM fx_costcenter_assignments LEFT JOIN fx_costcenters k ON k.objectId = costcenterObjectId),
wanted AS (
  (SELECT clientObjectId AS id FROM fx_care_allocations WHERE NOT coalesce({ended}, FALSE) INTERSECT SELECT id FROM home)
  EXCEPT SELECT clientObjectId FROM fx_relations
  WHERE clientContactRelationTypeId IN (SELECT objectId FROM fx_relation_types WHERE {types}))
SELECT DISTINCT id AS clientId, p.identificationNo AS clientNo, p.name AS clientname, no AS costcenterNo, label AS costcentreName
FROM wanted JOIN home USING (id) LEFT JOIN centre USING (place) LEFT JOIN fx_clients p ON p.objectId = id
WHERE {costcentre}
"""


def _minutes(text: str) -> str:
    return f"(substr({text}, 1, 2)::INT * 60 + substr({text}, 4, 2)::INT)"


def _span(start: str, stop: str) -> str:
    return f"(({_minutes(stop)} - {_minutes(start)} + 1440) % 1440)"


def r02(first: str | None = "DATE '2024-01-01'", last: str | None = "DATE '2024-01-31'") -> str:
    low, high = first or "DATE '2023-12-01'", last or "DATE '2024-03-01'"

    def days(table: str, begin: str, end: str, until: str) -> str:
        return (f"SELECT v.*, unnest(generate_series(greatest({begin}, {low}), least(coalesce({end}, {high}), {high}), "
                f"INTERVAL {until}))::DATE AS day FROM {table} v")
    return f"""
WITH work AS (
  SELECT w.*, p.external_id FROM fx_shift_assignments w JOIN fx_shift_employees p ON p.objectId = w.employee_id AND p.dummy IN (0, 2)
  WHERE discarded_at IS NULL AND date BETWEEN {low} AND {high}),
place AS (SELECT u.objectId, concat(u.code, ' ', u.name) AS own, u.external_id AS ext, concat(m.code, ' ', m.name) AS above
          FROM fx_units u LEFT JOIN fx_units m ON m.objectId = u.parent_unit_id),
team AS (SELECT employeeObjectId AS who, day, concat(t.identificationNo, ' ', t.name) AS label
         FROM ({days('fx_team_assignments', 'beginDate', 'endDate', '1 DAY')}) LEFT JOIN fx_teams t ON t.objectId = teamObjectId),
skill AS (SELECT employeeObjectId AS who, day, x.description AS label
          FROM ({days('fx_expertise_profile_assignments', 'startTime', 'endTime', '1 DAY')}) LEFT JOIN fx_expertise_profiles x ON x.objectId = expertiseProfileObjectId),
deal AS (SELECT employeeObjectId AS who, day, k.name AS label
         FROM ({days('fx_contracts', 'beginDate', 'endDate', '1 DAY')}) LEFT JOIN fx_contract_types k ON k.objectId = contractTypeObjectId),
version AS (SELECT timeline_id, day, description, x.name AS profile
            FROM ({days('fx_shifts', 'valid_from', 'valid_to - 1', '1 DAY')}) LEFT JOIN fx_shift_profiles x ON x.objectId = expertise_profile_id)
SELECT w.objectId AS msa_objectid, w.timeline_shift_id, version.description AS dienst, w.date AS datum_dienst,
  (SELECT concat(identificationNo, ' ', firstName, ' ', name) FROM (SELECT 1) LEFT JOIN fx_employees ON objectId = w.external_id) AS medewerker,
  coalesce(team.label, ' ') AS team_medewerker, skill.label AS deskundigheid_medewerker, deal.label AS contracttype_medewerker,
  coalesce(place.own, ' ') AS planbord, coalesce(CASE WHEN place.ext IS NOT NULL THEN place.own ELSE place.above END, ' ') AS kostenplaats,
  version.profile AS deskundigheid_dienst,
  substr(start_time, 1, 5) AS start_time, substr(stop_time, 1, 5) AS stop_time,
  substr(start_break_time, 1, 5) AS start_break_time, substr(stop_break_time, 1, 5) AS stop_break_time,
  CAST(({_span('start_time', 'stop_time')} - CASE WHEN start_break_time IS NULL THEN 0 ELSE {_span('start_break_time', 'stop_break_time')} END) / 60.0 AS DECIMAL(18,6)) AS dienstduur
FROM work w
LEFT JOIN place ON place.objectId = w.unit_id
LEFT JOIN version ON version.timeline_id = w.timeline_shift_id AND version.day = w.date
LEFT JOIN team ON team.who = w.external_id AND team.day = w.date
LEFT JOIN skill ON skill.who = w.external_id AND skill.day = w.date
LEFT JOIN deal ON deal.who = w.external_id AND deal.day = w.date
"""


def r03(first: str = "DATE '1998-01-01'", after: str = "DATE '1998-02-01'", kind: str = "lower(expense) LIKE '%gear%' OR lower(expense) LIKE 'red%'") -> str:
    return f"""
WITH centre AS (SELECT clusterObjectId AS cluster, k.identificationNo AS no, k.name AS label
                FROM fx_costcenter_assignments LEFT JOIN fx_costcenters k ON k.objectId = costcenterObjectId),
spent AS (SELECT x.*, y.objectId AS kind, y.name AS expense FROM fx_expenses x LEFT JOIN fx_expense_types y ON y.objectId = x.expenseTypeObjectId
          WHERE expenseDate >= {first} AND expenseDate < {after})
SELECT s.employeeObjectId AS employeeId, p.identificationNo AS employeeNo, p.contractId AS contractNo, p.name AS employeeName,
  no AS costscenterNo, label AS costcenter, kind AS expenseType, expense, sum(amount)::DECIMAL(38,4) AS amount
FROM (SELECT * FROM spent WHERE {kind}) s LEFT JOIN centre ON cluster = s.clusterObjectId LEFT JOIN fx_employees p ON p.objectId = s.employeeObjectId
GROUP BY ALL
"""


def r04(titles: str = "TRUE", dedupe: bool = False) -> str:
    many = "" if dedupe else "LEFT JOIN asked d ON d.rid = r.objectId AND d.day LEFT JOIN asked h ON h.rid = r.objectId AND h.hour"
    chains = "SELECT DISTINCT * FROM" if dedupe else "SELECT * FROM"
    return f"""
WITH asked AS (
  SELECT surveyResultObjectId AS rid, text_of ILIKE '%Datum%' AS day, lower(text_of) = '&amp;tijdstip incident&amp;' AS hour
  FROM (SELECT surveyResultObjectId, (SELECT q.text FROM fx_survey_questions q WHERE q.objectId = questionObjectId) AS text_of
        FROM fx_survey_answers WHERE text IS NOT NULL)),
points AS (SELECT surveyResultObjectId AS rid, (SELECT score FROM fx_survey_answer_definitions z WHERE z.objectId = answerDefinitionObjectId) AS score
           FROM fx_survey_answers),
centre AS (SELECT y.unitObjectId AS unit, y.clusterObjectId AS cluster, y.beginDate AS y0, coalesce(y.endDate, 'infinity'::DATE) AS y1, k.identificationNo AS no, k.name AS label,
             k.beginDate <= y.beginDate AND coalesce(k.endDate, 'infinity'::DATE) >= coalesce(y.endDate, 'infinity'::DATE) AS fits
           FROM fx_costcenter_assignments y LEFT JOIN fx_costcenters k ON k.objectId = y.costcenterObjectId),
staff AS ({chains} (
  SELECT r.objectId AS rid, CASE WHEN fits THEN no END AS no, CASE WHEN fits THEN label END AS label
  FROM fx_survey_results r JOIN fx_team_assignments g ON g.employeeObjectId = r.employeeObjectId
    AND r.createdAt BETWEEN g.beginDate AND coalesce(g.endDate, 'infinity'::DATE)
  LEFT JOIN centre ON cluster = g.teamObjectId AND y0 <= g.beginDate AND y1 >= coalesce(g.endDate, 'infinity'::DATE))),
homes AS ({chains} (
  SELECT r.objectId AS rid, CASE WHEN fits THEN no END AS no, CASE WHEN fits THEN label END AS label
  FROM fx_survey_results r JOIN fx_location_assignments g ON g.clientObjectId = r.clientObjectId AND g.locationType = 'MAIN'
    AND g.beginDate <= r.createdAt AND coalesce(g.endDate, 'infinity'::DATE) > r.createdAt
  LEFT JOIN centre ON unit = g.locationObjectId AND y0 <= g.beginDate AND y1 >= coalesce(g.endDate, 'infinity'::DATE)))
SELECT r.objectId AS Ingevulde_Vragenlijst, c.objectId AS ClientID, c.identificationNo AS Clientnummer, concat_ws(' ', c.initials, c.name) AS Clientnaam,
  e.objectId AS MedewerkerID, e.identificationNo AS Medewerkernummer, concat_ws(' ', e.initials, e.name) AS Medewerkernaam,
  concat_ws(' ', staff.no, staff.label) AS Kostenplaats_Mdw, concat_ws(' ', homes.no, homes.label) AS Kostenplaats_Client,
  strftime(ifnull(r.completedAt, r.createdAt), '%Y%m%d') AS Ingevuld_datum, strftime(ifnull(r.completedAt, r.createdAt), '%Y%m%d') AS Antwoord_datum,
  (r.completedAt IS NOT NULL)::INT::VARCHAR AS VragenlijstVoltooid, s.title AS Vragenlijst, substr(s.description, 1, 99) AS Toelichting_Titel,
  sum(points.score)::BIGINT AS TotaalScore,
  {", ".join(f"coalesce(any_value({flag}) = 1, FALSE)::INT AS {name}_" for flag, name in (("s.active", "a"), ("s.useStrictEditAuthorization", "b"), ("s.useWorkflow", "c")))},
  strftime(r.createdAt, '%Y%m%d') AS InvullenBegonnenOp, strftime(r.completedAt, '%Y%m%d') AS InvullenCompleetOp,
  coalesce((SELECT label FROM (VALUES {STATUS_ROWS}) z(code, label) WHERE code = r.status), '{STATUS_UNKNOWN}') AS Status
FROM fx_survey_results r LEFT JOIN fx_surveys s ON s.objectId = r.surveyObjectId
LEFT JOIN points ON points.rid = r.objectId {many}
LEFT JOIN staff ON staff.rid = r.objectId LEFT JOIN homes ON homes.rid = r.objectId
LEFT JOIN fx_clients c ON c.objectId = r.clientObjectId LEFT JOIN fx_employees e ON e.objectId = r.employeeObjectId
WHERE {titles}
GROUP BY r.objectId, r.completedAt, r.createdAt, r.status, s.title, s.description, c.objectId, c.identificationNo, c.initials, c.name,
  e.objectId, e.identificationNo, e.initials, e.name, staff.no, staff.label, homes.no, homes.label
"""


def _r04_named(sql: str) -> str:
    yes = "CASE WHEN {} = 1 THEN 'Ja' ELSE 'Nee' END AS {}"
    labels = ", ".join(yes.format(f"{x}_", n) for x, n in (
        ("a", "Vragenlijst_In_Gebruik"), ("b", "DeskundigheidRelevantVoorGebruik"), ("c", "BevatProcesstapBespreken")))
    return f"SELECT * EXCLUDE (a_, b_, c_), {labels} FROM ({sql})"


def r05(which: str = "TRUE") -> str:
    return f"""
WITH shown AS (
  SELECT a.surveyResultObjectId AS rid, a.objectId AS aid, q.objectId AS qid, q.text AS Vraag, q.additionalInfo AS info, d.score,
    q.answertype = 1 OR q.answertype = 2 AS choice,
    CASE WHEN a.text IS NULL AND (q.answertype = 1 OR q.answertype = 2) THEN d.definition WHEN a.booleanAnswer <> 0 THEN 'Ja' ELSE a.text END AS said
  FROM fx_survey_answers a LEFT JOIN fx_survey_questions q ON q.objectId = a.questionObjectId
  LEFT JOIN fx_survey_answer_definitions d ON d.objectId = a.answerDefinitionObjectId
  WHERE a.surveyResultObjectId IN (SELECT objectId FROM fx_survey_results) AND {which}),
kept AS (SELECT * FROM shown WHERE said IS NOT NULL)
SELECT k.rid::VARCHAR AS Ingevulde_Vragenlijst, n AS Sorteervolgorde_Vraag, Vraag, info AS Aanvullende_Info_Bij_Vraag, said AS Antwoord,
  if(coalesce(choice, FALSE), 'Meerkeuze', 'Open/getal/datum/tijd') AS Antwoord_Type, score AS Score_Meerkeuze, 'ONS' AS Bron
FROM kept k JOIN (
  SELECT x.aid, count(*) AS n FROM kept x JOIN kept y ON y.rid = x.rid AND (coalesce(y.qid, -1), y.aid) <= (coalesce(x.qid, -1), x.aid) GROUP BY x.aid) USING (aid)
"""


R06 = """
WITH seen AS (
  SELECT i.eventObjectId AS ev, count(DISTINCT c.objectId) AS n, list(DISTINCT l.externalObjectId) FILTER (l.objectId IS NOT NULL) AS places
  FROM fx_agenda_invitations i LEFT JOIN fx_agenda_clients c ON c.objectId = i.inviteeObjectId
  LEFT JOIN fx_agenda_locations l ON l.objectId = i.inviteeObjectId GROUP BY 1)
SELECT e.objectId AS eventObjectId, place AS locationObjectId, (SELECT name FROM fx_locations WHERE objectId = place) AS locatie,
  e.name AS afspraaktitel, e.comment AS commentaar, e.createdAt AS afspraak_aangemaakt, e.validFrom AS afspraak_start,
  e.validTo AS afspraak_einde, e.clientPresent AS client_aanwezig, n AS aantal_clienten
FROM (SELECT ev, n, unnest(coalesce(places, [NULL])) AS place FROM seen WHERE n >= 2) JOIN fx_agenda_events e ON e.objectId = ev
WHERE coalesce(e.validTo, 'infinity'::TIMESTAMP) >= TIMESTAMP '1998-09-01 12:00:00'
"""

R07 = """
WITH usable AS (
  SELECT careProviderObjectId AS who, a.* FROM fx_addresses a JOIN fx_care_provider_addresses ON addressObjectId = a.objectId
  WHERE length(trim(street)) > 0 AND DATE '1998-09-01' BETWEEN beginDate AND coalesce(endDate, 'infinity'::DATE))
SELECT p.fullName AS naam, u.street AS straatnaam, u.homeNumber AS huisnummer, u.homeNumberExtension AS huisnummer_toevoeging,
  u.zipcode AS postcode, u.city AS gemeente, u.telephoneNumber AS telefoonnummer, u.email
FROM fx_care_providers p LEFT JOIN (
  SELECT * FROM usable x WHERE (x.createdAt, x.objectId) = (SELECT max((y.createdAt, y.objectId)) FROM usable y WHERE y.who = x.who)) u ON u.who = p.objectId
WHERE p.organisationCategoryId IN (SELECT objectId FROM fx_care_provider_categories WHERE name ILIKE 'apothekers')
"""

R08 = """
SELECT clientObjectId, (SELECT identificationNo FROM fx_clients WHERE objectId = clientObjectId) AS identificationNo, 'Bewindvoerder' AS relationType,
  * EXCLUDE (objectId, clientObjectId, clientContactRelationTypeId, type)
FROM fx_relations
WHERE type IN (SELECT code FROM fx_relation_codes WHERE description ILIKE 'bewindvoerder') AND updatedAt >= DATE '1998-08-01'
"""

R09 = """
WITH place AS (SELECT * FROM fx_locations WHERE beginDate <= DATE '1998-09-01' AND NOT coalesce(endDate < DATE '1998-09-01', FALSE)),
stay AS (SELECT * FROM fx_location_assignments WHERE beginDate <= DATE '1998-09-01' AND NOT coalesce(endDate < DATE '1998-09-01', FALSE)),
care AS (SELECT * FROM fx_care_allocations WHERE dateBegin <= DATE '1998-09-01' AND NOT coalesce(dateEnd <= DATE '1998-09-01', FALSE))
SELECT p.objectId AS client_id, p.identificationNo AS clientnummer, givenName AS roepnaam, firstName AS voornaam, lastName AS achternaam,
  dateOfBirth AS geboortedatum, place.objectId AS locatie_id, place.name AS locatie_naam, place.identificationNo AS locatie_nummer,
  intramuralLocation AS intramuraal, locationType AS toekenning_type, residence AS verblijfslocatie,
  stay.beginDate AS locatie_begin, stay.endDate AS locatie_eind, dateBegin AS zorg_begin, dateEnd AS zorg_eind
FROM place JOIN stay ON stay.locationObjectId = place.objectId JOIN care USING (clientObjectId) JOIN fx_clients p ON p.objectId = clientObjectId
WHERE p.deathDate IS NULL
"""

R10 = """
WITH rights AS (SELECT * FROM fx_entitlements
  WHERE greatest(van, product_van) <= DATE '1998-09-01'
    AND least(coalesce(tot, 'infinity'::DATE), coalesce(product_tot, 'infinity'::DATE)) > DATE '1998-03-01'),
goods AS (SELECT clientObjectId AS who, list_sort(list(product) FILTER (product IS NOT NULL)) AS names FROM rights GROUP BY 1),
paths AS (SELECT clientObjectId AS who, count(*) AS n, list_sort(list(f.description) FILTER (f.description IS NOT NULL)) AS names
  FROM fx_youth_trajectories LEFT JOIN fx_youth_care_forms f ON f.code = hulpvorm
  WHERE datumAanvang <= DATE '1998-09-01' AND coalesce(datumBeeindiging, 'infinity'::DATE) >= DATE '1998-03-01' GROUP BY 1)
SELECT DISTINCT r.clientno, r.clientObjectId, r.client, strftime(r.geboren, '%d-%m-%Y') AS geboortedatum,
  ifnull(strftime(a.dateBegin, '%d-%m-%Y'), '') AS startdatum_in_zorg, ifnull(strftime(a.dateEnd, '%d-%m-%Y'), '') AS einddatum_in_zorg, r.legitimatie,
  coalesce(len(goods.names), 0) AS aantal_producten, coalesce(array_to_string(goods.names, ' | '), '') AS producten,
  coalesce(paths.n, 0) AS aantal_actieve_jeugdtrajecten, coalesce(array_to_string(paths.names, ' | '), '') AS actieve_jeugdtrajecten
FROM rights r JOIN fx_care_allocations a USING (clientObjectId) LEFT JOIN goods ON goods.who = r.clientObjectId LEFT JOIN paths ON paths.who = r.clientObjectId
WHERE contains(upper(r.legitimatie), 'JW') AND a.dateBegin <= DATE '1998-09-01' AND coalesce(a.dateEnd, 'infinity'::DATE) > DATE '1998-03-01'
"""


def r11(first: str = "DATE '1998-03-01'", last: str = "DATE '1998-09-01'") -> str:
    return f"""
SELECT t.clientObjectId, (SELECT identificationNo FROM fx_clients WHERE objectId = t.clientObjectId) AS clientnummer,
  (SELECT description FROM fx_youth_care_forms WHERE code = t.hulpvorm) AS hulpvorm, w.description AS verwijzer, datumAanvang, datumBeeindiging
FROM fx_youth_referrers w JOIN fx_youth_trajectories t ON t.verwijzer = w.code
WHERE w.description ILIKE 'geen verwijzer' AND datumAanvang <= {last} AND NOT coalesce(datumBeeindiging < {first}, FALSE)
"""


def r12(first: str | None = None, last: str | None = "DATE '1998-09-01'", names: tuple[str, ...] = ("Wachtlijst",)) -> str:
    def live(begin: str, end: str) -> str:
        return f"{f'{begin} <= {last}' if last else 'TRUE'} AND {f'coalesce({end}, {chr(39)}infinity{chr(39)}::DATE) >= {first}' if first else 'TRUE'}"
    unwanted = " OR ".join(f"contains(lower(l.name), '{n.lower()}')" for n in names) or "FALSE"
    return f"""
WITH care AS (SELECT * FROM fx_care_allocations WHERE {live('dateBegin', 'dateEnd')}),
home AS (SELECT * FROM fx_location_assignments WHERE locationType = 'MAIN' AND {live('beginDate', 'endDate')}),
last_care AS (SELECT arg_max(struct_pack(b := dateBegin, e := dateEnd), (coalesce(dateEnd, DATE '9999-12-31'), objectId)) AS v, clientObjectId AS who FROM care GROUP BY who),
open_home AS (SELECT * FROM home h WHERE endDate IS NULL AND NOT EXISTS (
  SELECT 1 FROM home o WHERE o.clientObjectId = h.clientObjectId AND coalesce(o.endDate, DATE '9999-12-31') >= DATE '9999-12-31' AND o.objectId > h.objectId))
SELECT who AS clientId, p.identificationNo AS client_nummer, p.name AS name, p.dateOfBirth AS geboortedatum, p.deathDate AS overlijdensdatum,
  v.b AS legitimatie_begin, v.e AS legitimatie_eind, l.name AS locatie, h.beginDate AS locatie_begin, h.endDate AS locatie_eind
FROM last_care JOIN open_home h ON h.clientObjectId = who LEFT JOIN fx_locations l ON l.objectId = h.locationObjectId LEFT JOIN fx_clients p ON p.objectId = who
WHERE v.e IS NOT NULL AND NOT coalesce({unwanted}, FALSE)
"""


R13 = f"""
WITH unit_codes(label, unit) AS (VALUES {UNIT_ROWS}),
product AS (SELECT p.objectId AS pid, p.code, p.vektiscode, f.id FROM fx_products p LEFT JOIN fx_finance_types f ON f.objectId = p.financeTypeObjectId)
SELECT product.id AS "Importcode legitimatie", product.code AS "productCode of importcode", product.vektiscode,
  (SELECT description FROM fx_debtor_types WHERE code = (SELECT type FROM fx_debtors WHERE objectId = t.debtorObjectId)) AS debtorType,
  (SELECT code FROM fx_uzovis WHERE objectId = (SELECT uzoviObjectId FROM fx_debtors WHERE objectId = t.debtorObjectId)) AS debtorUzoviCode,
  (SELECT debtorNumber FROM fx_debtors WHERE objectId = t.debtorObjectId) AS debiteurnummer,
  t.careProviderCode AS agbCode, t.tariffValue AS priceInCents,
  coalesce((SELECT any_value(unit) FROM unit_codes WHERE lower(label) = lower(u.description)), u.description) AS priceUnit,
  t.beginDate AS begindatum, t.endDate AS eindDatum
FROM fx_tariffs t LEFT JOIN product ON pid = t.productObjectId LEFT JOIN fx_tariff_units u ON u.code = t.tariffUnit
"""

R14 = """
WITH d AS (SELECT * FROM fx_documents WHERE confidential = 1),
grp AS (SELECT documentObjectId AS doc, (SELECT name FROM fx_expertise_groups WHERE objectId = expertiseGroupObjectId
          AND beginDate <= DATE '1998-09-01' AND NOT coalesce(endDate <= DATE '1998-09-01', FALSE)) AS label FROM fx_document_groups
        UNION ALL SELECT objectId, NULL FROM d WHERE objectId NOT IN (SELECT documentObjectId FROM fx_document_groups)),
prof AS (SELECT documentObjectId AS doc, description AS label, visible FROM fx_document_rights LEFT JOIN fx_expertise_profiles ON objectId = educationObjectId
         UNION ALL SELECT objectId, NULL, NULL FROM d WHERE objectId NOT IN (SELECT documentObjectId FROM fx_document_rights)),
tag AS (SELECT documentObjectId AS doc, (SELECT name FROM fx_tags WHERE objectId = tagObjectId) AS label FROM fx_document_tags
        UNION ALL SELECT objectId, NULL FROM d WHERE objectId NOT IN (SELECT documentObjectId FROM fx_document_tags))
SELECT d.objectId, d.employeeObjectId, d.description AS document_beschrijving, d.filename AS document_naam,
  (SELECT description FROM fx_document_statuses WHERE code = d.status) AS status, d.clientObjectId,
  (SELECT identificationNo FROM fx_clients WHERE objectId = d.clientObjectId) AS clientnummer, d.message AS melding, d.confidential AS vertrouwelijk,
  d.createdAt AS aangemaakt_op, d.updatedAt AS bewerkt_op, grp.label AS deskundigheidsgroep, prof.label AS deskundigheidsprofiel,
  prof.visible AS deskundigheidsprofiel_zichtbaar, tag.label AS document_label
FROM grp JOIN prof USING (doc) JOIN tag USING (doc) JOIN d ON d.objectId = doc
"""

R15 = """
WITH pool AS (SELECT t.objectId, t.identificationNo AS no, t.name AS label, k.description AS kind FROM fx_teams t LEFT JOIN fx_pool_types k ON k.code = t.poolcluster)
SELECT g.startDate AS startdatum, g.endDate AS einddatum, e.identificationNo AS medewerkernummer,
  trim(coalesce(e.lastName, '') || ', ' || coalesce(e.initials, '') || ' ' || coalesce(e.prefix, '')) AS employee_name,
  (SELECT description FROM fx_activities WHERE objectId = g.activityObjectId) AS uursoort_beschrijving,
  (SELECT identificationNo FROM fx_activities WHERE objectId = g.activityObjectId) AS uursoort_code,
  pool.no AS kostenplaatsnummer, pool.label AS kostenplaats_naam, pool.kind AS pool_type, g.clientId AS client_id, g.removed AS is_verwijderd,
  g.registration AS is_urenregistratie, g.payment AS is_voor_verloning, g.verified AS is_gefiatteerd, g.verifiedDate AS fiatteringsdatum
FROM fx_presence_logs g LEFT JOIN fx_employees e ON e.objectId = g.employeeId LEFT JOIN pool ON pool.objectId = g.costClusterObjectId
WHERE NOT (g.startDate > DATE '2024-01-10' OR coalesce(g.endDate, 'infinity'::TIMESTAMP) < DATE '2024-01-05')
"""

STARTER = "SELECT name AS kolom_1, identificationNo AS kolom_2 FROM fx_locations WHERE name = name"

R01, R02, R03, R04, R05, R11, R12 = r01(), r02(), r03(), _r04_named(r04()), r05(), r11(), r12()
