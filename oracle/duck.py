"""DuckDB SQL oracle.

the DataFrame code: the bindings of the test tables, then one statement per
query.  Tables ``region nation customer part orders lineitem`` are views the
driver registers.
"""

from __future__ import annotations

BINDINGS = """
o_d AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS o_date
  FROM orders
),
cohort AS (
  SELECT c.c_custkey AS person_id,
         f.pcr AS first_pos_pcr_antigen_date,
         f.dx AS first_pos_diagnosis_date,
         least(coalesce(f.pcr, f.dx), coalesce(f.dx, f.pcr)) AS first_poslab_or_diagnosis_date,
         least(coalesce(f.pcr, f.dx), coalesce(f.dx, f.pcr)) AS first_antigen_or_poslab_or_diagnosis_date
  FROM customer c
  LEFT JOIN (
    SELECT o_custkey,
           min(o_date) FILTER (WHERE o_orderpriority = '1-URGENT') AS pcr,
           min(o_date) FILTER (WHERE o_orderpriority = '2-HIGH') AS dx
    FROM o_d GROUP BY o_custkey
  ) f ON f.o_custkey = c.c_custkey
),
persons AS (
  SELECT c_custkey AS person_id,
         CAST(CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 1930 + c_custkey % 75 END AS INTEGER) AS year_of_birth,
         CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 12 + 1 END AS INTEGER) AS month_of_birth,
         CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 31 + 1 END AS INTEGER) AS day_of_birth,
         CASE c_custkey % 7 WHEN 0 THEN 'Hispanic or Latino' WHEN 1 THEN NULL
              ELSE 'Not Hispanic or Latino' END AS ethnicity_concept_name,
         (['Hispanic White', 'Black', 'African American', 'African', 'White',
           'Asian or Pacific Islander', 'Asian', 'Filipino', 'Chinese', 'Korean',
           'Vietnamese', 'Japanese', 'Bangladeshi', 'Pakistani', 'Nepalese', 'Laotian',
           'Taiwanese', 'Thai', 'Sri Lankan', 'Burmese', 'Okinawan', 'Cambodian',
           'Bhutanese', 'Singaporean', 'Hmong', 'Malaysian', 'Indonesian',
           'Native Hawaiian or Other Pacific Islander', 'Polynesian', 'Native Hawaiian',
           'Micronesian', 'Melanesian', 'Other Race', 'Multiple races',
           'More than one population', 'Barbadian', 'white', NULL])[c_custkey % 38 + 1] AS race_concept_name,
         CASE c_custkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'female'
              WHEN 3 THEN 'No matching concept' END AS gender_concept_name,
         CAST(CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_nationkey END AS BIGINT) AS location_id,
         CAST(c_nationkey % 6 AS BIGINT) AS data_partner_id
  FROM customer
),
location AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id,
         n_name AS city,
         'S' || CAST(n_regionkey AS VARCHAR) AS state,
         CASE n_nationkey % 6 WHEN 0 THEN '1000' || CAST(n_nationkey % 10 AS VARCHAR)
              WHEN 1 THEN ' 20001 ' WHEN 2 THEN '30001-1234' WHEN 3 THEN '4001'
              WHEN 4 THEN '50A01' END AS zip,
         'C' || CAST(n_nationkey AS VARCHAR) AS county
  FROM nation
),
manifest AS (
  SELECT CAST(r_regionkey AS BIGINT) AS data_partner_id,
         DATE '2022-06-10' AS run_date,
         r_name AS cdm_name,
         '5.3' AS cdm_version,
         CASE WHEN r_regionkey % 2 = 0 THEN 'Y' ELSE 'N' END AS shift_date_yn,
         CAST(10 * r_regionkey AS INTEGER) AS max_num_shift_days
  FROM region
),
visits AS (
  SELECT o.o_custkey AS person_id,
         l.l_orderkey * 10 + l.l_linenumber AS visit_occurrence_id,
         CAST(CASE WHEN o.o_orderstatus = 'O' THEN (CASE WHEN l.l_linenumber = 1 THEN 9202 ELSE 9300 + l.l_partkey % 10 END)
                   WHEN l.l_linenumber % 3 = 0 THEN 9201 ELSE 9202 END AS INTEGER) AS visit_concept_id,
         'visit ' || CAST(CASE WHEN o.o_orderstatus = 'O' THEN (CASE WHEN l.l_linenumber = 1 THEN 9202 ELSE 9300 + l.l_partkey % 10 END)
                   WHEN l.l_linenumber % 3 = 0 THEN 9201 ELSE 9202 END AS VARCHAR) AS visit_concept_name,
         CAST(l.l_shipdate AS DATE) AS visit_start_date,
         CAST(l.l_shipdate AS DATE) + CAST(l.l_linenumber % 4 AS INTEGER) AS visit_end_date,
         CASE WHEN o.o_orderstatus <> 'O' THEN CAST(o.o_orderkey AS VARCHAR) END AS macrovisit_id,
         CASE WHEN o.o_orderstatus <> 'O' THEN o.o_date END AS macrovisit_start_date,
         CASE WHEN o.o_orderstatus = 'F' THEN o.o_date + CAST(o.o_orderkey % 10 AS INTEGER) END AS macrovisit_end_date
  FROM lineitem l JOIN o_d o ON l.l_orderkey = o.o_orderkey
),
members AS (
  SELECT p_partkey AS concept_id, p_type AS concept_set_name, p_size % 2 = 0 AS is_most_recent_version FROM part
  UNION ALL SELECT CAST(9300 + p_size % 10 AS BIGINT), 'ER', p_size % 2 = 0 FROM part WHERE p_type = 'MEDIUM'
),
sets(concept_set_name, column_name, domain, comorbidity, er_only_visit) AS (
  VALUES ('SMALL', 'small_flag', 'condition_occurrence', 1, 0),
         ('LARGE', 'large_flag', 'condition_occurrence,drug_exposure', 1, 0),
         ('PROMO', 'promo_flag', 'condition_occurrence', 1, 0),
         ('MEDIUM', 'medium_flag', 'condition_occurrence', 0, 0),
         ('ECONOMY', 'economy_flag', 'drug_exposure', 1, 0),
         ('STANDARD', 'standard_flag', 'condition_occurrence', NULL, 0),
         ('NOEVENT', 'noevent_flag', 'condition_occurrence', 1, 0),
         ('ER', 'er_visit', 'visit_occurrence', 0, 1)
),
conditions AS (
  SELECT o.o_custkey AS person_id,
         CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END AS condition_start_date,
         l.l_partkey AS condition_concept_id
  FROM lineitem l JOIN o_d o ON l.l_orderkey = o.o_orderkey
),
death AS (
  SELECT o_custkey AS person_id, CAST(o_orderkey % 6 AS BIGINT) AS data_partner_id, o_date AS death_date
  FROM o_d WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
)"""

BIRTH = """CASE WHEN {y} IS NULL THEN NULL
     ELSE TRY_CAST(concat_ws('-', {y}, coalesce({m}, 1), coalesce({d}, 1)) AS DATE) END"""

AGE = """CAST(floor((12 * (year({a}) - year({b})) + (month({a}) - month({b}))
   - CASE WHEN day({a}) < day({b}) AND NOT ({a} = last_day({a}) AND {b} = last_day({b})) THEN 1 ELSE 0 END
  ) / 12.0) AS BIGINT)"""

GENDER = """CASE WHEN upper({g}) = 'MALE' THEN 'MALE' WHEN upper({g}) = 'FEMALE' THEN 'FEMALE' ELSE 'UNKNOWN' END"""

RACE = """CASE
  WHEN {e} = 'Hispanic or Latino' THEN 'Hispanic or Latino Any Race'
  WHEN contains({r}, 'Hispanic') THEN 'Hispanic or Latino Any Race'
  WHEN contains({r}, 'Black') THEN 'Black or African American Non-Hispanic'
  WHEN {r} = 'African American' THEN 'Black or African American Non-Hispanic'
  WHEN contains({r}, 'White') THEN 'White Non-Hispanic'
  WHEN {r} = 'Asian or Pacific Islander' THEN 'Unknown'
  WHEN contains({r}, 'Asian') OR contains({r}, 'Filipino') OR contains({r}, 'Chinese')
    OR contains({r}, 'Korean') OR contains({r}, 'Vietnamese') OR contains({r}, 'Japanese')
    OR contains({r}, 'Bangladeshi') OR contains({r}, 'Pakistani') OR contains({r}, 'Nepalese')
    OR contains({r}, 'Laotian') OR contains({r}, 'Taiwanese') OR contains({r}, 'Thai')
    OR contains({r}, 'Sri Lankan') OR contains({r}, 'Burmese') OR contains({r}, 'Okinawan')
    OR contains({r}, 'Cambodian') OR contains({r}, 'Bhutanese') OR contains({r}, 'Singaporean')
    OR contains({r}, 'Hmong') OR contains({r}, 'Malaysian') OR contains({r}, 'Indonesian')
    THEN 'Asian Non-Hispanic'
  WHEN contains({r}, 'Pacific') OR contains({r}, 'Polynesian') OR contains({r}, 'Native Hawaiian')
    OR contains({r}, 'Micronesian') OR contains({r}, 'Melanesian')
    THEN 'Native Hawaiian or Other Pacific Islander Non-Hispanic'
  WHEN contains({r}, 'Other') OR contains({r}, 'Multiple') OR contains({r}, 'More') THEN 'Other Non-Hispanic'
  ELSE 'UNKNOWN' END"""

ZIP = """CASE WHEN regexp_matches(
    CASE WHEN length(trim({z})) >= 5 THEN substr(trim({z}), 1, 5) END, '[0-9]{{5}}')
  THEN substr(trim({z}), 1, 5) END"""

FLAGS = ["large_flag", "noevent_flag", "promo_flag", "small_flag"]


def _flag_max(names):
    return ",\n         ".join(
        f"CAST(max(CASE WHEN k.column_name = '{n}' THEN 1 ELSE 0 END) AS INTEGER) AS {n}" for n in names
    )


def _window(event: str, before: int, after: int, both: bool) -> str:
    if both:
        return (
            f"date_diff('day', {event}, i.lab) BETWEEN -{after} AND {before} "
            f"AND date_diff('day', i.dx, i.lab) BETWEEN -{after} AND {before}"
        )
    return f"date_diff('day', {event}, i.idx) BETWEEN -{after} AND {before}"


def _fact_ctes(before: int = 1, after: int = 16, both: bool = False) -> str:
    """CTEs from the cohort to the person fact."""
    return f"""
enriched AS (
  SELECT c.person_id, c.first_pos_pcr_antigen_date, c.first_pos_diagnosis_date, c.first_poslab_or_diagnosis_date,
         p.year_of_birth, p.month_of_birth, p.day_of_birth, p.ethnicity_concept_name, p.race_concept_name,
         p.gender_concept_name, p.location_id, p.data_partner_id,
         l.city, l.state, l.zip, l.county,
         m.run_date, m.cdm_name, m.cdm_version, m.shift_date_yn, m.max_num_shift_days
  FROM cohort c
  LEFT JOIN persons p ON p.person_id = c.person_id
  LEFT JOIN location l ON l.location_id = p.location_id
  LEFT JOIN manifest m ON m.data_partner_id = p.data_partner_id
  WHERE c.first_poslab_or_diagnosis_date IS NOT NULL
),
born AS (
  SELECT *, {BIRTH.format(y="year_of_birth", m="month_of_birth", d="day_of_birth")} AS date_of_birth FROM enriched
),
clean AS (
  SELECT *,
         {AGE.format(a="first_poslab_or_diagnosis_date", b="date_of_birth")} AS age_at_covid,
         {GENDER.format(g="gender_concept_name")} AS gender,
         {RACE.format(r="race_concept_name", e="ethnicity_concept_name")} AS race_ethnicity,
         {ZIP.format(z="zip")} AS zip_code
  FROM born
),
comorbidity_concepts AS (
  SELECT m.concept_id, s.column_name
  FROM members m JOIN sets s ON s.concept_set_name = m.concept_set_name
  WHERE m.is_most_recent_version AND contains(s.domain, 'condition_occurrence') AND s.comorbidity = 1
),
by_visit AS (
  SELECT c.person_id, c.condition_start_date AS comorbidity_start_date,
         {_flag_max(FLAGS)}
  FROM conditions c JOIN comorbidity_concepts k ON k.concept_id = c.condition_concept_id
  WHERE c.condition_start_date IS NOT NULL AND c.person_id IN (SELECT person_id FROM clean)
  GROUP BY c.person_id, c.condition_start_date
),
by_person AS (
  SELECT person_id, {", ".join(f"max({n}) AS {n}" for n in FLAGS)} FROM by_visit GROUP BY person_id
),
with_flags AS (
  SELECT c.*, {", ".join(f"coalesce(b.{n}, 0) AS {n}" for n in FLAGS)}
  FROM clean c LEFT JOIN by_person b ON b.person_id = c.person_id
),
idx AS (
  SELECT person_id, first_pos_pcr_antigen_date AS lab, first_pos_diagnosis_date AS dx,
         first_poslab_or_diagnosis_date AS idx
  FROM clean
),
hosp AS (
  SELECT DISTINCT v.person_id, v.macrovisit_id,
         v.macrovisit_start_date AS covid_hospitalization_start_date,
         v.macrovisit_end_date AS covid_hospitalization_end_date
  FROM visits v JOIN idx i ON i.person_id = v.person_id
  WHERE v.macrovisit_start_date IS NOT NULL AND {_window("v.macrovisit_start_date", before, after, both)}
),
first_hosp AS (
  SELECT person_id, macrovisit_id,
         covid_hospitalization_start_date AS first_COVID_hospitalization_start_date,
         covid_hospitalization_end_date AS first_COVID_hospitalization_end_date
  FROM (
    SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY covid_hospitalization_start_date,
             covid_hospitalization_end_date NULLS FIRST, macrovisit_id) AS rn
    FROM hosp
  ) WHERE rn = 1
),
er_ids AS (
  SELECT DISTINCT m.concept_id
  FROM members m JOIN sets s ON s.concept_set_name = m.concept_set_name
  WHERE s.er_only_visit = 1 AND m.is_most_recent_version
),
er AS (
  SELECT DISTINCT v.person_id, v.visit_start_date AS covid_ER_only_start_date
  FROM visits v JOIN idx i ON i.person_id = v.person_id
  WHERE v.macrovisit_start_date IS NULL
    AND v.visit_concept_id IN (SELECT concept_id FROM er_ids)
    AND {_window("v.visit_start_date", before, after, both)}
),
first_er AS (
  SELECT person_id, min(covid_ER_only_start_date) AS first_covid_er_only_start_date FROM er GROUP BY person_id
),
first_visits AS (
  SELECT coalesce(h.person_id, e.person_id) AS person_id, h.macrovisit_id,
         h.first_COVID_hospitalization_start_date, h.first_COVID_hospitalization_end_date,
         e.first_covid_er_only_start_date
  FROM first_hosp h FULL OUTER JOIN first_er e ON e.person_id = h.person_id
),
fact AS (
  SELECT w.*, f.macrovisit_id, f.first_COVID_hospitalization_start_date,
         f.first_COVID_hospitalization_end_date, f.first_covid_er_only_start_date
  FROM with_flags w LEFT JOIN first_visits f ON f.person_id = w.person_id
),
stay_rows AS (
  SELECT DISTINCT person_id, macrovisit_id, macrovisit_start_date, macrovisit_end_date
  FROM visits WHERE macrovisit_id IS NOT NULL
),
later AS (
  SELECT person_id, first_poslab_or_diagnosis_date, first_COVID_hospitalization_start_date,
         first_COVID_hospitalization_end_date, macrovisit_id, macrovisit_start_date, macrovisit_end_date
  FROM (
    SELECT f.person_id, f.first_poslab_or_diagnosis_date, f.first_COVID_hospitalization_start_date,
           f.first_COVID_hospitalization_end_date, s.macrovisit_id, s.macrovisit_start_date, s.macrovisit_end_date,
           row_number() OVER (
             PARTITION BY f.person_id, f.first_poslab_or_diagnosis_date, f.first_COVID_hospitalization_start_date,
                          f.first_COVID_hospitalization_end_date, s.macrovisit_id
             ORDER BY s.macrovisit_start_date, s.macrovisit_end_date NULLS FIRST) AS rn
    FROM fact f JOIN stay_rows s ON s.person_id = f.person_id
    WHERE coalesce(f.first_COVID_hospitalization_start_date, f.first_poslab_or_diagnosis_date)
          < s.macrovisit_start_date
  ) WHERE rn = 1
)"""


def _q(final: str, **window) -> str:
    return f"WITH {BINDINGS},{_fact_ctes(**window)}\n{final}"


def _busiest(key: str) -> str:
    return (
        f"(SELECT {key} FROM visits WHERE macrovisit_id IS NOT NULL GROUP BY {key} "
        f"ORDER BY count(*) DESC, {key} ASC LIMIT 1)"
    )


VISIT_COLUMNS = (
    "person_id, macrovisit_id, visit_occurrence_id, visit_concept_id, visit_concept_name, "
    "visit_start_date, visit_end_date, macrovisit_start_date, macrovisit_end_date"
)

FIRST_HOSP_COLUMNS = (
    "person_id, macrovisit_id, first_COVID_hospitalization_start_date, first_COVID_hospitalization_end_date"
)


def oracle_sql() -> dict[str, str]:
    sql = {
        "sample_cohort": _q("SELECT * FROM cohort"),
        "sample_cohort_half": _q(
            "SELECT * FROM cohort WHERE ('0x' || substr(md5('111:' || person_id), 1, 8))::BIGINT < 2147483648"
        ),
        "sample_rows_half": _q(
            "SELECT person_id, condition_start_date, condition_concept_id FROM (SELECT *, row_number() OVER "
            "(PARTITION BY person_id, condition_start_date, condition_concept_id ORDER BY person_id) AS n FROM conditions) "
            "WHERE ('0x' || substr(md5('111|' || coalesce(CAST(person_id AS VARCHAR), '\\N') || '|' || "
            "coalesce(CAST(condition_start_date AS VARCHAR), '\\N') || '|' || coalesce(CAST(condition_concept_id AS VARCHAR), '\\N') "
            "|| '|' || n), 1, 8))::BIGINT < 2147483648"
        ),
        "enrich_locations": _q("SELECT * FROM enriched"),
        "clean_demographics": _q("SELECT * FROM clean"),
        "birth_date": _q(
            "SELECT person_id, year_of_birth, month_of_birth, day_of_birth, "
            f"{BIRTH.format(y='year_of_birth', m='month_of_birth', d='day_of_birth')} AS date_of_birth "
            "FROM persons"
        ),
        "age_at_index": _q(
            "SELECT person_id, first_poslab_or_diagnosis_date, date_of_birth, "
            f"{AGE.format(a='first_poslab_or_diagnosis_date', b='date_of_birth')} AS age_at_covid FROM ("
            "SELECT c.person_id, c.first_poslab_or_diagnosis_date, "
            f"{BIRTH.format(y='p.year_of_birth', m='p.month_of_birth', d='p.day_of_birth')} AS date_of_birth "
            "FROM cohort c LEFT JOIN persons p ON p.person_id = c.person_id)"
        ),
        "standard_gender": _q(
            f"SELECT person_id, gender_concept_name, {GENDER.format(g='gender_concept_name')} AS gender FROM persons"
        ),
        "race_ethnicity": _q(
            "SELECT person_id, race_concept_name, ethnicity_concept_name, "
            f"{RACE.format(r='race_concept_name', e='ethnicity_concept_name')} AS race_ethnicity FROM persons"
        ),
        "zip5": _q(f"SELECT location_id, zip, {ZIP.format(z='zip')} AS zip_code FROM location"),
        "comorbidity_by_visit": _q("SELECT * FROM by_visit"),
        "comorbidity_until_index": _q(
            f"SELECT c.person_id, c.condition_start_date AS comorbidity_start_date, {_flag_max(FLAGS)} "
            "FROM conditions c JOIN comorbidity_concepts k ON k.concept_id = c.condition_concept_id "
            "JOIN idx i ON i.person_id = c.person_id WHERE c.condition_start_date <= i.idx "
            "GROUP BY c.person_id, c.condition_start_date"
        ),
        "comorbidity_by_person": _q("SELECT * FROM by_person"),
        "person_with_comorbidities": _q("SELECT * FROM with_flags"),
        "er_concepts": _q("SELECT concept_id FROM er_ids"),
        "er_visits_either": _q("SELECT * FROM er"),
        "er_visits_both": _q("SELECT * FROM er", before=90, after=180, both=True),
        "hosp_either": _q("SELECT * FROM hosp"),
        "hosp_both": _q("SELECT * FROM hosp", both=True),
        "first_hosp": _q("SELECT * FROM first_hosp"),
        "first_er": _q("SELECT * FROM first_er"),
        "first_visits": _q("SELECT * FROM first_visits"),
        "first_visits_full_outer": _q("SELECT * FROM first_visits"),
        "first_visits_hosp_only": _q(
            f"SELECT c.person_id, h.macrovisit_id, h.first_COVID_hospitalization_start_date, "
            "h.first_COVID_hospitalization_end_date FROM clean c LEFT JOIN first_hosp h ON h.person_id = c.person_id"
        ),
        "covid_visits": _q("SELECT * FROM fact"),
        "person_fact": _q("SELECT * FROM fact"),
        "person_death": _q(
            "SELECT f.*, d.death_date FROM fact f LEFT JOIN death d ON d.person_id = f.person_id"
        ),
        "person_death_earliest": _q(
            "SELECT c.*, d.death_date FROM cohort c LEFT JOIN (SELECT person_id, min(death_date) AS death_date FROM death "
            "GROUP BY person_id) d ON d.person_id = c.person_id WHERE c.first_poslab_or_diagnosis_date IS NOT NULL"
        ),
        "visits_near_any_index": _q(
            "SELECT v.person_id, v.visit_occurrence_id, v.visit_start_date, i.index_date FROM visits v JOIN "
            "(SELECT DISTINCT o_custkey AS person_id, o_date AS index_date FROM o_d WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) i "
            "ON i.person_id = v.person_id WHERE date_diff('day', v.visit_start_date, i.index_date) BETWEEN -16 AND 1"
        ),
        "stays_after_index": _q("SELECT * FROM later"),
        "inpatient_codes_per_stay": _q(
            "SELECT macrovisit_id, count(visit_concept_id) AS multi_inpatient_codes FROM visits "
            "WHERE macrovisit_id IS NOT NULL AND visit_concept_id = 9201 GROUP BY macrovisit_id"
        ),
        "distinct_dates_per_stay": _q(
            "SELECT macrovisit_id, count(DISTINCT macrovisit_start_date) AS distinct_start_dates FROM visits "
            "WHERE macrovisit_id IS NOT NULL GROUP BY macrovisit_id"
        ),
        "visits_of_stay": _q(
            f"SELECT {VISIT_COLUMNS} FROM visits WHERE macrovisit_id = {_busiest('macrovisit_id')} "
            "ORDER BY visit_concept_id"
        ),
        "stay_timeline": _q(
            f"SELECT {VISIT_COLUMNS} FROM visits WHERE macrovisit_id IS NOT NULL "
            f"AND person_id = {_busiest('person_id')} ORDER BY macrovisit_start_date"
        ),
    }
    return sql
