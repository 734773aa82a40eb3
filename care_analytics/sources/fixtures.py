"""Test adapters: the reference tables derived from the driver's Parquet.

The reference ships no data, so each of its tables is modelled as a view over
the driver tables (TPC-H-ish ``customer``, ``orders``, ``lineitem``,
``events``, ``documents`` ...).  Every view is ONE portable SELECT: Spark runs
it with the source DataFrames bound to the ``{name}`` placeholders, and the
DuckDB oracle runs the very same text as a ``WITH`` prefix.  In production the
reference tables exist as real tables and this module is not used.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame, SparkSession

# Raw driver tables the adapters read.
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents")

# One SELECT per adapter; ``{x}`` is a driver table or another adapter.
VIEWS: dict[str, str] = {
    # every lineitem, with a key of its own (lines of one order and part are numbered)
    "fx_line": """SELECT (l_orderkey*10000000+l_partkey)*16 + ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_partkey
          ORDER BY l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate) AS line_id,
        l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
        CAST(l_shipdate AS DATE) AS ship_d FROM {lineitem}""",
    "fx_clients": """SELECT c_custkey AS objectId, CAST(c_custkey+100000 AS STRING) AS identificationNo,
        c_name AS name, c_mktsegment AS lastName, substr(c_name,1,8) AS firstName, substr(c_name,10) AS givenName,
        CASE WHEN c_custkey % 6 <> 0 THEN substr(c_mktsegment,1,1) END AS initials,
        DATE '1940-01-01' + CAST(c_custkey % 20000 AS INT) AS dateOfBirth,
        CASE WHEN c_custkey % 17 = 0 THEN DATE '1997-01-01' END AS deathDate FROM {customer}""",
    "fx_care_allocations": """SELECT o_orderkey AS objectId, o_custkey AS clientObjectId,
        CAST(o_orderdate AS DATE) AS dateBegin,
        CASE WHEN o_orderkey % 25 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 700 AS INT) END AS dateEnd
        FROM {orders}""",
    "fx_locations": """SELECT s_suppkey AS objectId,
        CASE WHEN s_suppkey % 10 = 3 THEN concat('Wachtlijst ', s_name) WHEN s_suppkey % 10 = 7 THEN NULL ELSE s_name END AS name,
        CAST(s_suppkey AS STRING) AS identificationNo, s_suppkey % 2 AS intramuralLocation,
        DATE '1995-01-01' AS beginDate, CASE WHEN s_suppkey % 9 = 0 THEN DATE '1998-01-01' END AS endDate
        FROM {supplier}""",
    "fx_location_assignments": """SELECT f.line_id AS objectId, o.o_custkey AS clientObjectId, f.l_suppkey AS locationObjectId,
        CASE f.l_returnflag WHEN 'A' THEN 'MAIN' WHEN 'N' THEN 'STANDARD' ELSE 'WAITING' END AS locationType,
        CASE WHEN f.l_linestatus = 'O' THEN 1 ELSE 0 END AS residence, f.ship_d AS beginDate,
        CASE WHEN f.l_partkey % 10 <> 0 THEN f.ship_d + CAST(f.l_partkey % 900 AS INT) END AS endDate
        FROM {fx_line} f JOIN {orders} o ON o.o_orderkey = f.l_orderkey""",
    "fx_costcenters": """SELECT n_nationkey AS objectId,
        CASE WHEN n_nationkey % 8 = 0 THEN concat('K', CAST(n_nationkey AS STRING)) ELSE CAST(1000 + n_nationkey*100 AS STRING) END AS identificationNo,
        n_name AS name, DATE '1990-01-01' AS beginDate, CASE WHEN n_nationkey % 6 = 0 THEN DATE '1999-12-31' END AS endDate
        FROM {nation}""",
    "fx_costcenter_assignments": """SELECT s_suppkey AS objectId, s_suppkey AS unitObjectId, s_suppkey AS clusterObjectId,
        s_nationkey AS costcenterObjectId, DATE '1994-01-01' AS beginDate,
        CASE WHEN s_suppkey % 4 = 0 THEN DATE '2000-12-31' END AS endDate FROM {supplier}""",
    "fx_relation_types": """SELECT r_regionkey AS objectId,
        CASE r_name WHEN 'AFRICA' THEN 'Eerste contactpersoon' WHEN 'ASIA' THEN 'Tweede contactpersoon' ELSE r_name END AS name
        FROM {region}""",
    "fx_relations": """SELECT o_orderkey AS objectId, o_custkey AS clientObjectId, o_orderkey % 40 AS clientContactRelationTypeId,
        o_orderpriority AS type, o_orderstatus AS firstName, o_orderpriority AS birthName, o_orderstatus AS initials,
        CAST(NULL AS STRING) AS birthNamePrefix, o_orderstatus AS name, CAST(NULL AS STRING) AS prefix,
        o_orderpriority AS organization, o_orderpriority AS comments, CAST(o_orderdate AS DATE) AS createdAt,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS updatedAt FROM {orders}""",
    "fx_relation_codes": """SELECT DISTINCT o_orderpriority AS code,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Bewindvoerder' ELSE o_orderpriority END AS description
        FROM {orders} WHERE o_orderpriority <> '5-LOW'""",
    "fx_employees": """SELECT c_custkey AS objectId, CAST(c_custkey+500000 AS STRING) AS identificationNo,
        CASE WHEN c_custkey % 4 <> 0 THEN substr(c_name,1,8) END AS firstName, c_name AS name, c_name AS lastName,
        substr(c_mktsegment,1,1) AS initials, CASE WHEN c_custkey % 3 = 0 THEN 'van' END AS prefix,
        c_custkey*10 AS contractId FROM {customer}""",
    "fx_teams": """SELECT s_suppkey AS objectId, CAST(s_suppkey+7000 AS STRING) AS identificationNo, s_name AS name,
        s_nationkey AS poolcluster FROM {supplier}""",
    "fx_team_assignments": """SELECT event_id AS objectId, user_id AS employeeObjectId, event_id % (SELECT count(*) FROM {supplier}) AS teamObjectId,
        CASE WHEN event_id % 4 = 0 THEN DATE '1996-01-01' + CAST(event_id % 1500 AS INT) ELSE CAST(ts AS DATE) - CAST(event_id % 9 AS INT) END AS beginDate,
        CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 8 = 0 THEN DATE '2001-06-30'
             WHEN event_id % 4 = 0 THEN DATE '1996-01-01' + CAST(event_id % 1500 + 200 AS INT)
             WHEN event_id % 3 <> 0 THEN CAST(ts AS DATE) + CAST(event_id % 7 AS INT) END AS endDate
        FROM {events} WHERE event_type = 'signup'""",
    "fx_shift_assignments": """SELECT event_id AS objectId, event_id % (SELECT count(*) FROM {part} WHERE p_partkey % 3 = 0) AS timeline_shift_id, event_id % (SELECT count(*) FROM {supplier}) AS unit_id,
        user_id AS employee_id, CAST(ts AS DATE) AS date, substr(CAST(ts AS STRING),12,8) AS start_time,
        substr(CAST(ts + INTERVAL 8 HOUR AS STRING),12,8) AS stop_time,
        CASE WHEN event_id % 3 <> 0 THEN substr(CAST(ts + INTERVAL 4 HOUR AS STRING),12,8) END AS start_break_time,
        CASE WHEN event_id % 3 <> 0 THEN substr(CAST(ts + INTERVAL 270 MINUTE AS STRING),12,8) END AS stop_break_time,
        CASE WHEN event_type = 'error' THEN ts END AS discarded_at FROM {events}""",
    "fx_units": """SELECT s_suppkey AS objectId, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey AS BIGINT) % 5 END AS parent_unit_id,
        concat('U', CAST(s_suppkey AS STRING)) AS code, s_name AS name,
        CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS external_id FROM {supplier}""",
    # three versions of ten days for each shift line
    "fx_shifts": """SELECT p_partkey AS objectId, CAST((p_partkey - p_partkey % 3) / 3 AS BIGINT) AS timeline_id, p_name AS description,
        DATE '2024-01-01' + CAST(10 * (p_partkey % 3) AS INT) AS valid_from,
        CASE WHEN p_partkey % 3 < 2 THEN DATE '2024-01-11' + CAST(10 * (p_partkey % 3) AS INT) END AS valid_to,
        p_partkey % 5 AS expertise_profile_id FROM {part}""",
    "fx_shift_employees": """SELECT c_custkey AS objectId, c_custkey AS external_id,
        CASE WHEN c_custkey % 13 = 0 THEN 1 WHEN c_custkey % 13 = 1 THEN NULL ELSE 0 END AS dummy FROM {customer}""",
    "fx_expenses": """SELECT line_id AS objectId, l_orderkey % (SELECT count(*) FROM {customer}) AS employeeObjectId, l_partkey AS expenseTypeObjectId,
        l_suppkey AS clusterObjectId, ship_d AS expenseDate, CAST(l_extendedprice AS DECIMAL(18,4)) AS amount FROM {fx_line}""",
    "fx_expense_types": """SELECT p_partkey AS objectId, p_name AS name FROM {part} WHERE p_partkey % 10 <> 9""",
    "fx_surveys": """SELECT p_partkey AS objectId, p_name AS title, concat(p_name, ' ', repeat('x', 120)) AS description,
        p_partkey % 2 AS active, p_partkey % 3 AS useStrictEditAuthorization, p_partkey % 4 AS useWorkflow FROM {part}""",
    "fx_survey_results": """SELECT o_orderkey AS objectId, o_orderkey % (SELECT count(*) FROM {part}) AS surveyObjectId, o_custkey AS clientObjectId,
        o_custkey % (SELECT 1 + max(user_id) FROM {events}) AS employeeObjectId, o_orderdate AS createdAt,
        CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 3 DAY END AS completedAt,
        CAST(o_orderkey % 6 AS INT) AS status FROM {orders}""",
    "fx_survey_questions": """SELECT p_partkey AS objectId,
        CASE WHEN p_partkey % 20 = 0 THEN 'Datum incident' WHEN p_partkey % 20 = 1 THEN '&amp;Tijdstip incident&amp;' ELSE p_name END AS text,
        p_type AS additionalInfo, p_partkey % 5 AS answertype FROM {part}""",
    "fx_survey_answers": """SELECT line_id AS objectId, l_orderkey AS surveyResultObjectId, l_partkey AS questionObjectId,
        l_linenumber AS answerDefinitionObjectId,
        CASE WHEN l_partkey % 20 = 0 THEN concat(substr(CAST(ship_d AS STRING),9,2), '-', substr(CAST(ship_d AS STRING),6,2), '-', substr(CAST(ship_d AS STRING),1,4))
             WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS text,
        CASE WHEN l_partkey % 4 = 0 THEN 1 WHEN l_partkey % 4 = 1 THEN 0 END AS booleanAnswer FROM {fx_line}""",
    "fx_survey_answer_definitions": """SELECT DISTINCT l_linenumber AS objectId, concat('def', CAST(l_linenumber AS STRING)) AS definition,
        l_linenumber * 2 AS score FROM {lineitem}""",
    "fx_agenda_events": """SELECT o_orderkey AS objectId, o_orderpriority AS name, o_orderstatus AS comment, o_orderdate AS createdAt,
        o_orderdate AS validFrom, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + INTERVAL 90 DAY END AS validTo,
        CAST(o_orderkey % 2 AS INT) AS clientPresent FROM {orders}""",
    "fx_agenda_invitations": """SELECT line_id AS objectId, l_orderkey AS eventObjectId, l_partkey AS inviteeObjectId FROM {fx_line}""",
    "fx_agenda_clients": """SELECT p_partkey AS objectId FROM {part} WHERE p_partkey % 3 <> 0""",
    "fx_agenda_locations": """SELECT p_partkey AS objectId, p_partkey % (SELECT count(*) FROM {supplier}) AS externalObjectId FROM {part} WHERE p_partkey % 3 = 0""",
    "fx_care_providers": """SELECT s_suppkey AS objectId, s_name AS fullName, s_nationkey AS organisationCategoryId FROM {supplier}""",
    "fx_care_provider_categories": """SELECT n_nationkey AS objectId,
        CASE WHEN n_nationkey % 3 = 0 THEN 'Apothekers' ELSE n_name END AS name FROM {nation}""",
    "fx_addresses": """SELECT line_id AS objectId,
        CASE WHEN l_partkey % 5 = 0 THEN '   ' WHEN l_partkey % 5 = 1 THEN NULL ELSE l_returnflag END AS street,
        CAST(l_linenumber AS STRING) AS homeNumber, CAST(NULL AS STRING) AS homeNumberExtension,
        concat('Z', CAST(l_suppkey AS STRING)) AS zipcode, CAST(l_orderkey AS STRING) AS telephoneNumber,
        CAST(line_id AS STRING) AS email, l_linestatus AS city, ship_d AS beginDate,
        CASE WHEN l_partkey % 2 = 0 THEN ship_d + CAST(l_partkey AS INT) END AS endDate, ship_d AS createdAt FROM {fx_line}""",
    "fx_care_provider_addresses": """SELECT l_suppkey AS careProviderObjectId, line_id AS addressObjectId FROM {fx_line} WHERE l_suppkey % 7 <> 0""",
    "fx_entitlements": """SELECT f.line_id AS objectId, o.o_custkey AS clientObjectId, CAST(o.o_custkey+100000 AS STRING) AS clientno,
        concat('Customer#', CAST(o.o_custkey AS STRING)) AS client, DATE '1990-01-01' + CAST(o.o_custkey % 6000 AS INT) AS geboren,
        CASE f.l_returnflag WHEN 'A' THEN 'JW 2015' WHEN 'N' THEN 'WLZ' ELSE 'WMO' END AS legitimatie,
        CASE WHEN f.l_partkey % 6 <> 0 THEN concat('P', CAST(f.l_partkey % 50 AS STRING)) END AS product,
        f.ship_d AS van, CASE WHEN f.l_partkey % 4 <> 0 THEN f.ship_d + 200 END AS tot, f.ship_d + 5 AS product_van,
        CASE WHEN f.l_partkey % 3 <> 0 THEN f.ship_d + 190 END AS product_tot
        FROM {fx_line} f JOIN {orders} o ON o.o_orderkey = f.l_orderkey""",
    "fx_youth_trajectories": """SELECT o_orderkey AS objectId, o_custkey AS clientObjectId, o_orderpriority AS hulpvorm,
        o_orderstatus AS verwijzer, CAST(o_orderdate AS DATE) AS datumAanvang,
        CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 120 END AS datumBeeindiging FROM {orders}""",
    "fx_youth_referrers": """SELECT DISTINCT o_orderstatus AS code,
        CASE o_orderstatus WHEN 'P' THEN 'Geen verwijzer' ELSE o_orderstatus END AS description FROM {orders}""",
    "fx_tariffs": """SELECT line_id AS objectId, l_partkey AS productObjectId, l_suppkey AS debtorObjectId, l_linenumber AS tariffUnit,
        l_extendedprice AS tariffValue, CAST(l_suppkey AS STRING) AS careProviderCode, ship_d AS beginDate,
        ship_d + 365 AS endDate FROM {fx_line}""",
    "fx_tariff_units": """SELECT * FROM (VALUES (1,'dagdeel'),(2,'uur'),(3,'kwartier'),(4,'stuk'),(5,'Onbekende eenheid'),
        (6,CAST(NULL AS STRING))) t(code, description)""",
    "fx_documents": """SELECT doc_id AS objectId, doc_id % (SELECT count(*) FROM {customer}) AS clientObjectId, source AS description, doc_id % (SELECT count(*) FROM {customer}) AS employeeObjectId,
        concat('f', CAST(doc_id AS STRING)) AS filename, lang AS message, DATE '1998-01-01' + CAST(doc_id % 300 AS INT) AS createdAt,
        DATE '1998-06-01' + CAST(doc_id % 300 AS INT) AS updatedAt, CAST(doc_id % 3 AS INT) AS status,
        CASE WHEN doc_id % 4 = 0 THEN 1 WHEN doc_id % 4 = 1 THEN NULL ELSE 0 END AS confidential FROM {documents}""",
    "fx_document_tags": """SELECT doc_id AS documentObjectId, CAST(0 AS BIGINT) AS tagObjectId FROM {documents} WHERE doc_id % 2 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(1 AS BIGINT) AS tagObjectId FROM {documents} WHERE doc_id % 3 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(2 AS BIGINT) AS tagObjectId FROM {documents} WHERE doc_id % 4 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(3 AS BIGINT) AS tagObjectId FROM {documents} WHERE doc_id % 5 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(4 AS BIGINT) AS tagObjectId FROM {documents} WHERE doc_id % 6 = 0""",
    "fx_tags": """SELECT r_regionkey AS objectId, r_name AS name FROM {region} WHERE r_regionkey <> 4""",
    "fx_presence_logs": """SELECT event_id AS objectId, user_id AS employeeId, event_id % (SELECT count(*) FROM {supplier}) AS costClusterObjectId,
        event_type AS activityObjectId, ts AS startDate, CASE WHEN event_id % 5 <> 0 THEN ts + INTERVAL 8 HOUR END AS endDate,
        event_id % (SELECT count(*) FROM {customer}) AS clientId, CAST(event_id % 11 AS INT) AS removed, 1 AS registration, CAST(event_id % 3 AS INT) AS payment,
        CAST(event_id % 2 AS INT) AS verified, CASE WHEN event_id % 2 = 1 THEN ts + INTERVAL 2 DAY END AS verifiedDate
        FROM {events}""",
    "fx_shift_profiles": """SELECT r_regionkey AS objectId, r_name AS name FROM {region}""",
    "fx_expertise_profiles": """SELECT n_nationkey AS objectId, n_name AS description, n_nationkey % 2 AS visible FROM {nation}""",
    "fx_expertise_profile_assignments": """SELECT event_id AS objectId, user_id AS employeeObjectId,
        event_id % 25 AS expertiseProfileObjectId, CAST(ts AS DATE) - 3 AS startTime,
        CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) + CAST(event_id % 12 AS INT) END AS endTime
        FROM {events} WHERE event_type = 'purchase'""",
    "fx_contracts": """SELECT c_custkey AS objectId, c_custkey AS employeeObjectId, c_nationkey AS contractTypeObjectId,
        DATE '2023-01-01' + CAST(c_custkey % 380 AS INT) AS beginDate,
        CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-01-20' END AS endDate FROM {customer}""",
    "fx_contract_types": """SELECT n_nationkey AS objectId, n_name AS name FROM {nation}""",
    "fx_youth_care_forms": """SELECT DISTINCT o_orderpriority AS code,
        CASE WHEN o_orderpriority <> '2-HIGH' THEN concat('Vorm ', o_orderpriority) END AS description FROM {orders}""",
    "fx_products": """SELECT p_partkey AS objectId, p_brand AS code, p_type AS vektiscode, p_size AS financeTypeObjectId FROM {part}""",
    "fx_finance_types": """SELECT DISTINCT p_size AS objectId, concat('F', CAST(p_size AS STRING)) AS id FROM {part} WHERE p_size % 5 <> 0""",
    "fx_debtors": """SELECT s_suppkey AS objectId, s_name AS debtorNumber, s_suppkey % 4 AS type, s_nationkey AS uzoviObjectId FROM {supplier}""",
    "fx_debtor_types": """SELECT r_regionkey AS code, r_name AS description FROM {region}""",
    "fx_uzovis": """SELECT n_nationkey AS objectId, n_name AS code FROM {nation}""",
    "fx_document_statuses": """SELECT r_regionkey AS code, r_name AS description FROM {region}""",
    "fx_document_groups": """SELECT doc_id AS documentObjectId, CAST(0 AS BIGINT) AS expertiseGroupObjectId FROM {documents} WHERE doc_id % 3 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(1 AS BIGINT) AS expertiseGroupObjectId FROM {documents} WHERE doc_id % 4 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(2 AS BIGINT) AS expertiseGroupObjectId FROM {documents} WHERE doc_id % 5 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(3 AS BIGINT) AS expertiseGroupObjectId FROM {documents} WHERE doc_id % 6 = 0
        UNION ALL SELECT doc_id AS documentObjectId, CAST(4 AS BIGINT) AS expertiseGroupObjectId FROM {documents} WHERE doc_id % 7 = 0""",
    "fx_expertise_groups": """SELECT r_regionkey AS objectId, r_name AS name, DATE '1995-01-01' AS beginDate,
        CASE WHEN r_regionkey % 2 = 0 THEN DATE '1998-01-01' END AS endDate FROM {region}""",
    "fx_document_rights": """SELECT doc_id AS documentObjectId, doc_id % 25 AS educationObjectId FROM {documents} WHERE doc_id % 3 <> 0""",
    "fx_activities": """SELECT DISTINCT event_type AS objectId, concat('A ', event_type) AS description,
        substr(event_type,1,3) AS identificationNo FROM {events} WHERE event_type <> 'view'""",
    # spellings of one text: case and trailing blanks differ
    "fx_spellings": """SELECT c_custkey AS objectId, c_nationkey AS nation, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
        CASE c_custkey % 4 WHEN 0 THEN upper(c_mktsegment) WHEN 1 THEN concat(lower(c_mktsegment), '  ') WHEN 2 THEN concat(substr(c_mktsegment,1,1), lower(substr(c_mktsegment,2))) END AS segment,
        CASE WHEN c_custkey % 3 = 0 THEN concat('Plaats ', CAST(c_custkey % 40 AS STRING)) ELSE concat('PLAATS ', CAST(c_custkey % 40 AS STRING), ' ') END AS city FROM {customer}""",
    # dates as people write them; ``parts``: without a year
    "fx_written_dates": """SELECT line_id AS objectId, ship_d AS d, line_id % 12 IN (8, 9) AS parts,
        CASE line_id % 12 WHEN 0 THEN concat(CAST(day(ship_d) AS STRING), ' ', split_part('januari,februari,maart,april,mei,juni,juli,augustus,september,oktober,november,december', ',', CAST(month(ship_d) AS INT)), ' ', CAST(year(ship_d) AS STRING))
          WHEN 1 THEN concat('Maandag, ', CAST(day(ship_d) AS STRING), '  ', split_part('JAN,feb,mrt.,Apr,mei,jun,jul,aug.,sep,okt,nov,dec', ',', CAST(month(ship_d) AS INT)), ' ', CAST(year(ship_d) AS STRING))
          WHEN 2 THEN concat(CAST(day(ship_d) AS STRING), '-', CAST(month(ship_d) AS STRING), '-', substr(CAST(year(ship_d) AS STRING), 3))
          WHEN 3 THEN replace(CAST(ship_d AS STRING), '-', '')
          WHEN 4 THEN concat(CAST(ship_d AS STRING), 'T13:45:01')
          WHEN 5 THEN concat(CAST(day(ship_d) AS STRING), '/', CAST(month(ship_d) AS STRING), '/', CAST(year(ship_d) AS STRING), ' 9:05')
          WHEN 6 THEN concat(' zo. ', CAST(day(ship_d) AS STRING), '.', CAST(month(ship_d) AS STRING), '.', CAST(year(ship_d) AS STRING), ' ')
          WHEN 7 THEN concat(CAST(year(ship_d) AS STRING), '/', CAST(month(ship_d) AS STRING), '/', CAST(day(ship_d) AS STRING))
          WHEN 8 THEN concat(CAST(day(ship_d) AS STRING), ' ', split_part('januari,februari,maart,april,mei,juni,juli,augustus,september,oktober,november,december', ',', CAST(month(ship_d) AS INT)))
          WHEN 9 THEN concat(CAST(day(ship_d) AS STRING), '-', CAST(month(ship_d) AS STRING))
          WHEN 10 THEN concat(CAST(day(ship_d) AS STRING), '-', split_part('jan,feb,mrt,apr,mei,jun,jul,aug,sep,okt,nov,dec', ',', CAST(month(ship_d) AS INT)), '-', substr(CAST(year(ship_d) AS STRING), 3), ' 23:59:59.5')
          ELSE concat('di ', CAST(ship_d AS STRING)) END AS written FROM {fx_line}
        WHERE NOT (line_id % 12 IN (8, 9) AND month(ship_d) = 2 AND day(ship_d) = 29)""",
    "fx_pool_types": """SELECT n_nationkey AS code, n_name AS description FROM {nation} WHERE n_nationkey % 2 = 0""",
}

# The reference's table names, each with the adapter that stands for it.
REFERENCE_TABLES: dict[str, str] = {
    "clients": "fx_clients",
    "care_allocations": "fx_care_allocations",
    "location_assignments": "fx_location_assignments",
    "locations": "fx_locations",
    "costcenter_assignments": "fx_costcenter_assignments",
    "costcenters": "fx_costcenters",
    "relations": "fx_relations",
    "nexus_client_contact_relation_types": "fx_relation_types",
    "lst_wlz_cod472s": "fx_relation_codes",
    "moves_shift_assignments": "fx_shift_assignments",
    "moves_units": "fx_units",
    "moves_shifts": "fx_shifts",
    "moves_expertise_profiles": "fx_shift_profiles",
    "moves_employees": "fx_shift_employees",
    "employees": "fx_employees",
    "team_assignments": "fx_team_assignments",
    "teams": "fx_teams",
    "expertise_profile_assignments": "fx_expertise_profile_assignments",
    "expertise_profiles": "fx_expertise_profiles",
    "contracts": "fx_contracts",
    "contract_types": "fx_contract_types",
    "expenses": "fx_expenses",
    "expense_types": "fx_expense_types",
    "surveys": "fx_surveys",
    "survey_results": "fx_survey_results",
    "survey_answers": "fx_survey_answers",
    "survey_questions": "fx_survey_questions",
    "survey_answer_definitions": "fx_survey_answer_definitions",
    "agenda_events": "fx_agenda_events",
    "agenda_invitations": "fx_agenda_invitations",
    "onsagenda_clients": "fx_agenda_clients",
    "onsagenda_locations": "fx_agenda_locations",
    "care_providers": "fx_care_providers",
    "care_provider_categories": "fx_care_provider_categories",
    "care_provider_addresses": "fx_care_provider_addresses",
    "addresses": "fx_addresses",
    "legitimaties": "fx_entitlements",
    "cbsbj_jeugdhulps": "fx_youth_trajectories",
    "cbsbj_hulpvormen": "fx_youth_care_forms",
    "cbsbj_verwijzers": "fx_youth_referrers",
    "declaration_tariffs": "fx_tariffs",
    "products": "fx_products",
    "finance_types": "fx_finance_types",
    "lst_export_units": "fx_tariff_units",
    "debtors": "fx_debtors",
    "lst_debtor_types": "fx_debtor_types",
    "uzovis": "fx_uzovis",
    "documents": "fx_documents",
    "document_expertise_groups": "fx_document_groups",
    "expertise_groups": "fx_expertise_groups",
    "document_rights": "fx_document_rights",
    "document_tags": "fx_document_tags",
    "tags": "fx_tags",
    "lst_document_statuses": "fx_document_statuses",
    "presence_logs": "fx_presence_logs",
    "lst_pool_types": "fx_pool_types",
    "activities": "fx_activities",
}


def dependencies(view: str) -> list[str]:
    """Names referenced as ``{x}`` placeholders in an adapter."""
    return list(dict.fromkeys(f for _, f, _, _ in string.Formatter().parse(VIEWS[view]) if f))


def build_view(spark: SparkSession, view: str, resolve) -> DataFrame:
    """Build one adapter as a Spark DataFrame; ``resolve(name)`` gives inputs."""
    deps = {name: resolve(name) for name in dependencies(view)}
    return spark.sql(VIEWS[view], **deps)


_FX = re.compile(r"\bfx_[a-z_]+\b")


def oracle_prefix(sql: str) -> str:
    """Prefix ``sql`` with the adapters it names, as DuckDB CTEs.

    ``sql`` may start with its own ``WITH``; its CTEs follow the adapters.
    """
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed or name not in VIEWS:
            return
        for dep in dependencies(name):
            visit(dep)
        needed.append(name)

    for name in _FX.findall(sql):
        visit(name)
    if not needed:
        return sql
    ctes = []
    for name in needed:
        body = VIEWS[name].format(**{d: d for d in dependencies(name)})
        ctes.append(f"{name} AS ({body})")
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + body
