"""The indicator catalogue: every published run as parameters (data, not code).

Each row is one call of an analysis stage: ``second`` rows are indicator runs
(rates + labels), ``deprivation`` rows are inequality runs.  Parameters not
stated for a run stay ``None``.  ``to_spec`` validates a row the same way a
hand-written spec is validated, so a row that cannot run (an unsupported
rolling period, a crude rate without its multiplier) is reported when the
catalogue is loaded, not in the middle of a job.
"""

from __future__ import annotations

from dataclasses import dataclass

from .spec import IndicatorSpec

FIELDS = ("ind_id", "dataset", "stage", "measure", "time_agg", "year_type", "yearstart", "yearend",
          "geography", "epop_age", "epop_total", "crude_rate", "adp", "hscp", "pop")

# The published runs and their parameters.
RUNS = [
    (20902, 'access_deprived_all', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20902, 'access_deprived_depr', 'deprivation', 'percent', 1, 'calendar', 2002, 2019, None, None, None, None, False, False, 'depr_pop_allages'),
    (13040, 'active_travel', 'second', 'percent', 1, 'school', 2008, 2018, 'council', None, None, None, False, False, None),
    (4119, 'Alcohol_waiting_times', 'second', 'percent', 1, 'financial', None, None, None, None, None, None, False, False, None),
    (20203, 'alcohol_stays_dz11', 'second', 'stdrate', 1, 'financial', 2002, 2019, 'datazone11', 'normal', 200000, None, True, False, 'DZ11_pop_allages'),
    (20203, 'alcohol_stays_depr', 'deprivation', 'stdrate', 1, 'financial', 2002, 2019, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (13024, 'alcohol_stays_11to25', 'second', 'stdrate', 3, 'financial', 2002, 2019, 'council', '11to25', 34200, None, True, False, 'CA_pop_11to25'),
    (20204, 'alcohol_deaths_dz11', 'second', 'stdrate', 5, 'calendar', 2002, 2019, 'datazone11', 'normal', 200000, None, True, False, 'DZ11_pop_allages'),
    (20204, 'alcohol_deaths_depr', 'deprivation', 'stdrate', 5, 'calendar', 2002, 2019, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (12537, 'alcohol_deaths_female', 'second', 'stdrate', 5, 'calendar', 2002, 2019, 'datazone11', 'normal', 100000, None, True, False, 'DZ11_pop_allages'),
    (12536, 'alcohol_deaths_male', 'second', 'stdrate', 5, 'calendar', 2002, 2019, 'datazone11', 'normal', 100000, None, True, False, 'DZ11_pop_allages'),
    (20304, 'asthma_dz11', 'second', 'stdrate', 3, 'financial', 2002, 2019, 'datazone11', 'normal', 200000, None, False, False, 'DZ11_pop_allages'),
    (20304, 'asthma_depr', 'deprivation', 'stdrate', 3, 'financial', 2002, 2019, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (13051, 'asthma_under16', 'second', 'stdrate', 3, 'financial', 2002, 2019, 'council', '<16', 34200, None, False, True, 'CA_pop_under16'),
    (1544, 'cessation_products', 'second', 'crude', 1, 'financial', 2002, 2019, 'council', None, None, 1000, False, True, 'CA_pop_12+'),
    (21102, 'bowel_screening', 'second', 'percent', 3, 'calendar', 2008, 2018, 'datazone11', None, None, None, False, False, None),
    (21102, 'bowel_screening', 'deprivation', 'percent', 3, 'calendar', 2014, 2018, 'datazone11', None, None, None, False, False, None),
    (21004, 'breastfed', 'second', 'percent', 3, 'financial', 2002, 2019, 'datazone11', None, None, None, False, False, None),
    (1547, 'copd_deaths', 'second', 'stdrate', 3, 'calendar', 2002, 2019, 'council', '16+', 165800, None, False, False, 'CA_pop_16+'),
    (1550, 'copd_incidence', 'second', 'stdrate', 3, 'financial', 2002, 2019, 'council', '16+', 165800, None, False, False, 'CA_pop_16+'),
    (20302, 'copd_hospital_dz11', 'second', 'stdrate', 3, 'financial', 2002, 2019, 'datazone11', 'normal', 165800, None, False, False, 'DZ11_pop_16+'),
    (20302, 'copd_hospital_depr', 'deprivation', 'stdrate', 3, 'financial', 2002, 2019, None, 'normal', 165800, None, False, False, 'depr_pop_16+'),
    (20301, 'cancer_reg_dz11', 'second', 'stdrate', 3, 'calendar', 2002, 2018, 'datazone11', 'normal', 200000, None, False, False, 'DZ11_pop_allages'),
    (20301, 'cancer_reg_depr', 'deprivation', 'stdrate', 3, 'calendar', 2002, 2017, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (21005, 'child_dental_p1', 'second', 'perc_pcf', 1, 'school', 2012, 2018, 'datazone11', None, None, None, False, False, 'DZ11_pop_5'),
    (21005, 'child_dental_p1_depr', 'deprivation', 'perc_pcf', 1, 'school', 2014, 2018, None, None, None, None, False, False, 'depr_pop_5'),
    (21006, 'child_dental_p7', 'second', 'perc_pcf', 1, 'school', 2012, 2018, 'datazone11', None, None, None, False, False, 'DZ11_pop_11'),
    (21006, 'child_dental_p7_depr', 'deprivation', 'perc_pcf', 1, 'school', 2014, 2018, None, None, None, None, False, False, 'depr_pop_11'),
    (21106, 'child_healthyweight', 'second', 'perc_pcf', 1, 'financial', 2002, 2018, 'datazone11', None, None, None, False, False, 'DZ11_pop_5'),
    (21103, 'Immunisation_5in1_dz11', 'second', 'percent', 3, 'calendar', 2004, 2019, 'datazone11', None, None, None, False, False, None),
    (21103, 'Immunisation_5in1_depr', 'deprivation', 'percent', 3, 'calendar', 2003, 2019, None, None, None, None, False, False, None),
    (21104, 'Immunisation_MMR_dz11', 'second', 'percent', 3, 'calendar', 2004, 2019, 'datazone11', None, None, None, False, False, None),
    (21104, 'Immunisation_MMR_depr', 'deprivation', 'percent', 3, 'calendar', 2003, 2019, None, None, None, None, False, False, None),
    (13027, 'children_low_income', 'second', 'percent', 1, 'calendar', 2013, 2016, 'datazone11', None, None, None, False, False, None),
    (13038, 'looked_after', 'second', 'crude', 1, 'July snapshot', 2011, 2018, 'council', None, None, 1000, False, False, None),
    (13001, 'scra_care_protection', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 1000, False, False, None),
    (20803, 'scra_offence', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 1000, False, False, None),
    (20801, 'crime_rate_all', 'second', 'crude', 1, 'calendar', None, None, None, None, None, 1000, False, False, None),
    (20801, 'crime_rate_depr', 'deprivation', 'crude', 1, 'calendar', 2004, 2019, None, None, None, 1000, False, False, 'depr_pop_allages'),
    (20103, 'deaths_allages_dz11', 'second', 'stdrate', 3, 'calendar', 2002, 2019, 'datazone11', 'normal', 200000, None, False, False, 'DZ11_pop_allages'),
    (20103, 'deaths_allages_depr', 'deprivation', 'stdrate', 3, 'calendar', 2002, 2019, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (20104, 'deaths_15to44_dz11', 'second', 'stdrate', 3, 'calendar', 2002, 2019, 'datazone11', 'normal', 76000, None, False, False, 'DZ11_pop_15to44'),
    (20104, 'deaths_15to44_depr', 'deprivation', 'stdrate', 3, 'calendar', 2002, 2019, None, 'normal', 76000, None, False, False, 'depr_pop_15to44'),
    (20403, 'deaths_suicide_dz11', 'second', 'stdrate', 5, 'calendar', 2002, 2018, 'datazone11', 'normal', 200000, None, False, False, 'DZ11_pop_allages'),
    (20403, 'suicide_depr', 'deprivation', 'stdrate', 5, 'financial', 2002, 2018, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (12539, 'suicides_female', 'second', 'stdrate', 5, 'calendar', 2002, 2018, 'council', 'normal', 100000, None, False, False, 'CA_pop_allages'),
    (12538, 'suicides_male', 'second', 'stdrate', 5, 'calendar', 2002, 2018, 'council', 'normal', 100000, None, False, False, 'CA_pop_allages'),
    (13033, 'suicides_young', 'second', 'crude', 5, 'calendar', 2002, 2018, 'council', '11to25', 34200, 100000, False, False, 'CA_pop_11to25'),
    (20901, 'derelict_site', 'second', 'percent', 1, 'calendar', 2016, 2017, 'datazone11', None, None, None, False, False, None),
    (4136, 'Drug_waiting_times', 'second', 'percent', 1, 'financial', None, None, None, None, None, None, False, False, None),
    (20205, 'drug_stays_dz11', 'second', 'stdrate', 3, 'financial', 2002, 2018, 'datazone11', 'normal', 200000, None, True, False, 'DZ11_pop_allages'),
    (20205, 'drug_stays_depr', 'deprivation', 'stdrate', 3, 'financial', 2002, 2018, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (13025, 'drug_stays_11to25', 'second', 'stdrate', 3, 'financial', 2002, 2018, 'council', '11to25', 34200, None, False, False, 'CA_pop_11to25'),
    (4121, 'drug_deaths', 'second', 'stdrate', 1, 'calendar', 2006, 2019, 'council', 'normal', 200000, None, True, True, 'CA_pop_allages'),
    (4121, 'drug_deaths_depr', 'deprivation', 'stdrate', 5, 'calendar', 2006, 2019, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (12535, 'drug_deaths_female', 'second', 'stdrate', 5, 'calendar', 2006, 2019, 'council', 'normal', 100000, None, True, True, 'CA_pop_allages'),
    (12534, 'drug_deaths_male', 'second', 'stdrate', 5, 'calendar', 2006, 2019, 'council', 'normal', 100000, None, True, True, 'CA_pop_allages'),
    (20105, 'deaths_CHD_dz11', 'second', 'stdrate', 3, 'calendar', 2002, 2019, 'datazone11', 'normal', 182000, None, False, False, 'DZ11_pop_under75'),
    (20105, 'deaths_CHD_depr', 'deprivation', 'stdrate', 3, 'calendar', 2002, 2019, None, 'normal', 182000, None, False, False, 'depr_pop_under75'),
    (20106, 'early_cancer_deaths_dz11', 'second', 'stdrate', 3, 'calendar', 2002, 2020, 'datazone11', 'normal', 182000, None, False, False, 'DZ11_pop_under75'),
    (20106, 'early_cancer_deaths_depr', 'deprivation', 'stdrate', 3, 'calendar', 2002, 2020, None, 'normal', 182000, None, False, False, 'depr_pop_under75'),
    (20305, 'ea', 'second', 'stdrate', 3, 'calendar', 2002, 2019, 'all', 'normal', 200000, None, False, True, 'c(DZ11_pop_allages, DZ11_pop_65+)'),
    (20306, 'ma', 'second', 'stdrate', 3, 'calendar', 2002, 2019, 'all', 'normal', 39000, None, False, True, 'c(DZ11_pop_allages, DZ11_pop_65+)'),
    (20702, 'employment_deprived_all', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20702, 'employment_deprived_depr', 'deprivation', 'percent', 1, 'calendar', 2004, 2019, None, None, None, None, False, False, 'depr_working_pop'),
    (13037, 'exposure_smoking', 'second', 'percent', 3, 'financial', 2002, 2019, 'council', None, None, None, False, True, None),
    (13012, 'school_meals', 'second', 'percent', 1, 'school', 2015, 2019, 'council', None, None, None, False, False, None),
    (13032, 'hpv_uptake', 'second', 'percent', 3, 'school', 2009, 2019, 'datazone11', None, None, None, False, False, None),
    (13032, 'hpv_uptake', 'deprivation', 'percent', 3, 'school', 2014, 2019, 'datazone11', None, None, None, False, False, None),
    (21105, 'healthy_birth', 'second', 'percent', 3, 'financial', 2002, 2019, 'datazone11', None, None, None, False, False, None),
    (21105, 'healthy_birth_depr', 'deprivation', 'percent', 3, 'financial', 2014, 2019, None, None, None, None, False, False, None),
    (20502, 'high_care_needs', 'second', 'percent', 1, 'financial', 2006, 2018, 'council', None, None, None, False, False, None),
    (4144, 'premises_total', 'second', 'crude', 1, 'financial', 2011, 2018, 'council', None, None, 10000, True, False, 'CA_pop_18+'),
    (4114, 'premises_on', 'second', 'crude', 1, 'financial', 2011, 2018, 'council', None, None, 10000, True, False, 'CA_pop_18+'),
    (4139, 'premises_off', 'second', 'crude', 1, 'financial', 2011, 2018, 'council', None, None, 10000, True, False, 'CA_pop_18+'),
    (4140, 'personal', 'second', 'crude', 1, 'financial', 2011, 2018, 'council', None, None, 10000, True, False, 'CA_pop_18+'),
    (20008, 'live_births', 'second', 'crude', 1, 'calendar', 2002, 2018, 'datazone11', None, None, 1000, False, False, 'DZ11_pop_allages'),
    (13007, 'looked_after_SCQF4', 'second', 'percent', 1, 'school', 2009, 2017, 'council', None, None, None, False, False, None),
    (13011, 'looked_after_positive_dest', 'second', 'percent', 1, 'school', 2009, 2018, 'council', None, None, None, False, False, None),
    (1546, 'lungcancer_deaths', 'second', 'stdrate', 3, 'calendar', 2002, 2018, 'council', '16+', 165800, None, False, True, 'CA_pop_16+'),
    (1549, 'lungcancer_reg', 'second', 'stdrate', 3, 'calendar', 2002, 2018, 'council', '16+', 165800, None, False, True, 'CA_pop_16+'),
    (13021, 'mat_obesity', 'second', 'percent', 3, 'financial', 2010, 2019, 'datazone11', None, None, None, False, False, None),
    (13021, 'mat_obesity_depr', 'deprivation', 'percent', 3, 'financial', 2014, 2019, None, None, None, None, False, False, None),
    (20002, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (4162, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20003, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20005, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (1504, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20006, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20007, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20004, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (4161, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (13101, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (13105, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (13102, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (13103, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (13104, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (1502, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (1503, 'file_list', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20701, 'income_deprived_all', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20701, 'income_deprived_depr', 'deprivation', 'percent', 1, 'calendar', 2004, 2019, None, None, None, None, False, False, 'depr_pop_allages'),
    (1552, 'postpartum_smoking', 'second', 'percent', 3, 'financial', 2002, 2018, 'council', None, None, None, False, True, None),
    (13022, 'premature_births', 'second', 'percent', 3, 'financial', 2002, 2019, 'datazone11', None, None, None, False, False, None),
    (13022, 'premature_births_depr', 'deprivation', 'percent', 3, 'financial', 2014, 2019, None, None, None, None, False, False, None),
    (20401, 'prescriptions_anxiety', 'second', 'percent', 1, 'financial', 2010, 2019, 'datazone11', None, None, None, False, False, 'DZ11_pop_allages'),
    (20401, 'prescriptions_anxiety_depr', 'deprivation', 'percent', 1, 'financial', 2014, 2019, None, None, None, None, False, False, 'depr_pop_allages'),
    (20402, 'psychiatric_discharges_dz11', 'second', 'stdrate', 3, 'financial', 2002, 2018, 'datazone11', 'normal', 200000, None, False, False, 'DZ11_pop_allages'),
    (20402, 'psychiatric_discharges_depr', 'deprivation', 'stdrate', 3, 'financial', 2002, 2018, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (1537, 'quitattempts_12weeks', 'second', 'percent', 1, 'financial', 2009, 2019, 'council', None, None, None, False, True, None),
    (1536, 'quitattempts_4weeks', 'second', 'percent', 1, 'financial', 2009, 2019, 'council', None, None, None, False, True, None),
    (1539, 'filenames', 'second', 'percent', 1, 'financial', 2009, 2019, 'council', None, None, None, False, False, None),
    (1540, 'filenames', 'second', 'percent', 1, 'financial', 2009, 2019, 'council', None, None, None, False, False, None),
    (1541, 'filenames', 'second', 'percent', 1, 'financial', 2009, 2019, 'council', None, None, None, False, False, None),
    (1542, 'filenames', 'second', 'percent', 1, 'financial', 2009, 2019, 'council', None, None, None, False, False, None),
    (1543, 'filenames', 'second', 'percent', 1, 'financial', 2009, 2019, 'council', None, None, None, False, False, None),
    (1526, 'quitattempts_pregnant', 'second', 'percent', 3, 'financial', 2009, 2018, 'council', None, None, None, False, False, None),
    (4111, 'att_murder', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 10000, True, False, 'CA_pop_allages'),
    (4156, 'breach', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 10000, True, False, 'CA_pop_allages'),
    (4154, 'comm_assault', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 10000, True, False, 'CA_pop_allages'),
    (20806, 'drugs', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 10000, True, False, 'CA_pop_allages'),
    (4155, 'vandalism', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 10000, True, False, 'CA_pop_allages'),
    (20805, 'violence', 'second', 'crude', 1, 'financial', 2004, 2018, 'council', None, None, 10000, True, False, 'CA_pop_allages'),
    (4137, 'sdmd_initialcompl', 'second', 'percent', 1, 'financial', None, None, None, None, None, None, False, False, None),
    (4138, 'sdmd_follow', 'second', 'percent', 1, 'financial', None, None, None, None, None, None, False, False, None),
    (13016, 'school_exclusion', 'second', 'crude', 1, 'school', 2009, 2018, 'council', None, None, None, False, False, None),
    (13010, 'school_leaver_destinations', 'second', 'percent', 1, 'school', 2009, 2017, 'council', None, None, None, False, False, None),
    (20504, 'Single_Dwellings_all', 'second', 'percent', 1, 'calendar', None, None, None, None, None, None, False, False, None),
    (20504, 'Single_Dwellings_depr', 'deprivation', 'percent', 1, 'calendar', 2007, 2019, None, None, None, None, False, False, None),
    (1548, 'smoking_adm', 'second', 'stdrate', 2, 'calendar', 2012, 2018, 'all', 'normal', 120000, None, False, False, 'CA_pop_allages'),
    (20201, 'smoking_deaths', 'second', 'stdrate', 2, 'calendar', 2012, 2018, 'all', 'normal', 120000, None, False, False, 'CA_pop_allages'),
    (21002, 'smoking_preg', 'second', 'percent', 3, 'financial', 2003, 2018, 'datazone11', None, None, None, False, False, None),
    (21002, 'smoking_preg_depr', 'deprivation', 'percent', 3, 'financial', 2003, 2018, None, None, None, None, False, False, None),
    (1521, 'quint_files', 'second', 'percent', 3, 'financial', 2003, 2018, 'datazone11', None, None, None, False, False, None),
    (1522, 'quint_files', 'second', 'percent', 3, 'financial', 2003, 2018, 'datazone11', None, None, None, False, False, None),
    (1523, 'quint_files', 'second', 'percent', 3, 'financial', 2003, 2018, 'datazone11', None, None, None, False, False, None),
    (1524, 'quint_files', 'second', 'percent', 3, 'financial', 2003, 2018, 'datazone11', None, None, None, False, False, None),
    (1525, 'quint_files', 'second', 'percent', 3, 'financial', 2003, 2018, 'datazone11', None, None, None, False, False, None),
    (21001, 'teen_preg', 'second', 'crude', 3, 'calendar', 2002, 2018, 'datazone11', None, None, 1000, False, False, 'DZ11_pop_fem15to19'),
    (21001, 'teen_preg', 'deprivation', 'crude', 3, 'calendar', 2014, 2018, 'datazone11', None, None, 1000, False, False, 'depr_pop_fem15to19'),
    (13005, 'young_people_crime', 'second', 'percent', 1, 'calendar', 2011, 2018, 'datazone11', None, None, None, False, False, 'DZ11_pop_under26'),
    (13003, 'young_people_access', 'second', 'percent', 1, 'calendar', 2011, 2018, 'datazone11', None, None, None, False, False, 'DZ11_pop_under26'),
    (13004, 'young_people_income', 'second', 'percent', 1, 'calendar', 2011, 2018, 'datazone11', None, None, None, False, False, 'DZ11_pop_under26'),
    (13048, 'dev_concerns', 'second', 'percent', 3, 'financial', 2013, 2020, 'datazone11', None, None, None, False, True, None),
    (4122, 'hepc_pwid', 'second', 'percent', 1, 'financial', None, None, None, None, None, None, False, False, None),
    (20303, 'hospitalisation_CHD_dz11', 'second', 'stdrate', 3, 'financial', 2002, 2019, 'datazone11', 'normal', 200000, None, False, False, 'DZ11_pop_allages'),
    (20303, 'hospitalisation_CHD_depr', 'deprivation', 'stdrate', 3, 'financial', 2002, 2019, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (20307, 'roadaccidents_dz11', 'second', 'stdrate', 3, 'calendar', 2002, 2019, 'datazone11', 'normal', 200000, None, False, False, 'DZ11_pop_allages'),
    (20307, 'roadaccidents_depr', 'deprivation', 'stdrate', 3, 'calendar', 2002, 2019, None, 'normal', 200000, None, False, False, 'depr_pop_allages'),
    (13050, 'unintentional_under5', 'second', 'stdrate', 3, 'financial', 2005, 2019, 'council', 'normal', 10000, None, False, True, 'CA_pop_under5'),
    (13049, 'youngassault_ca2019', 'second', 'stdrate', 3, 'financial', 2005, 2019, 'council', '15to25', 25400, None, False, True, 'CA_pop_15to25'),
]


@dataclass(frozen=True)
class CatalogueEntry:
    ind_id: int | None
    dataset: str
    stage: str
    measure: str
    time_agg: int | None
    year_type: str
    yearstart: int | None
    yearend: int | None
    geography: str | None
    epop_age: str | None
    epop_total: float | None
    crude_rate: float | None
    adp: bool
    hscp: bool
    pop: str | None

    def to_spec(self, yearstart: int | None = None, yearend: int | None = None, geography: str | None = None) -> IndicatorSpec:
        """An :class:`IndicatorSpec`; runs whose years or geography come from their input take them as arguments.

        An inequality run starts from datazones; any other run without a
        geography is an error.
        """
        start = self.yearstart if self.yearstart is not None else yearstart
        end = self.yearend if self.yearend is not None else yearend
        if start is None or end is None:
            raise ValueError(f"{self.dataset}: years not in the catalogue; pass yearstart/yearend")
        if self.time_agg is None:
            raise ValueError(f"{self.dataset}: no rolling period")
        where = self.geography or geography or ("datazone11" if self.stage == "deprivation" else None)
        if where is None:
            raise ValueError(f"{self.dataset}: geography not in the catalogue; pass geography")
        return IndicatorSpec(ind_id=self.ind_id or 0, measure=self.measure, time_agg=int(self.time_agg),
                             yearstart=int(start), yearend=int(end), year_type=self.year_type,
                             geography=where,
                             epop_age=self.epop_age, epop_total=self.epop_total,
                             crude_rate=self.crude_rate, adp=self.adp, hscp=self.hscp)


def entries() -> list[CatalogueEntry]:
    return [CatalogueEntry(*r) for r in RUNS]


def validate(yearstart: int = 2002, yearend: int = 2019, geography: str | None = "all") -> dict[str, str]:
    """dataset/stage -> error for every row that cannot run as written, its open years and geography given."""
    errors = {}
    for e in entries():
        try:
            e.to_spec(yearstart, yearend, geography)
        except ValueError as exc:
            errors[f"{e.dataset}/{e.stage}/{e.ind_id}"] = str(exc)
    return errors
