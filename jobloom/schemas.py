"""Declared schemas of the tables the library reads and writes."""

from __future__ import annotations

LISTINGS = "name string, key string, title string, location string"
JOB_URLS = "job_listing_url string"
COMPANY_URLS = "Company_name_url string"
ERRORS = "msg string, urls string"

DETAILS_A = (
    "name string, key string, title string, location string, jobType string, posted string, days_ago int, "
    "rating double, experience array<string>, salary array<struct<amount:string,per:string,unit:string>>, "
    "education array<string>, feed string, link string, Tools array<string>, `Soft Skills` array<string>, "
    "`Industry Skills` array<string>, description string"
)
DETAILS_B = (
    "posted string, Experience string, location string, jobType string, Education string, description string, "
    "name string, title string, feed string"
)

MATCHED = "employer_name string, company_name string, Company_name_url string"
PEOPLE = (
    "`Company ID` string, `Company Name` string, `Name from URL` string, `People Name` string, "
    "`Linkedin Profile` string, `Job Title` string, `Job Category` array<string>, Departments array<string>"
)
COMPANY_INFO = (
    "`Company ID` string, `Company Name` string, `Name from URL` string, Description string, `Company Size` string, "
    "City string, State string, Country string, `Business Category` array<string>, `Founded at (Date)` string, "
    "`IPO status` string, `E-mail` string, `Phone:` string, Linkedin string, Facebook string, Twitter string, "
    "`Funding Rounds` bigint, `Funding Total (USD)` double, Acquisitions array<string>, Investments array<string>, "
    "`Lead Investments` bigint, Investors array<string>, `Lead Investors` bigint, `Total Products Active` bigint, "
    "`Active Tech Count` bigint, `Monthly Visits` bigint, `Monthly Visits Change(%)` double, "
    "`Similar Companies` array<string>"
)

# --- JSON carried by pages -------------------------------------------------------------------------------------------
# Every single value is read as text: one that comes as a number here and as text there costs nothing else of its page.

LISTING_STATE = (
    "metaData struct<mosaicProviderJobCardsModel:struct<results:array<"
    "struct<company:string,jobkey:string,displayTitle:string,formattedLocation:string>>>>"
)
LISTING_INFO = "searchTitleBarModel struct<totalNumResults:string>, pageLinks array<string>"

DETAIL_STATE = (
    "jobKey string, hiringInsightsModel struct<age:string>, "
    "hostQueryExecutionResult struct<data:struct<jobData:struct<results:array<struct<job:struct<"
    "url:string,employer:struct<relativeCompanyPageUrl:string>>>>>>>, "
    "jobInfoWrapperModel struct<jobInfoModel:struct<sanitizedJobDescription:string,"
    "jobMetadataHeaderModel:struct<jobType:string>,"
    "jobInfoHeaderModel:struct<companyName:string,companyReviewModel:struct<ratingsModel:struct<rating:string>>>>>"
)

_NAMED = "struct<value:string>"

ORGANIZATION = (
    "properties struct<title:string,short_description:string,identifier:struct<permalink:string,image_id:string>>, "
    "cards struct<"
    "overview_description:struct<description:string>,"
    f"company_about_fields2:struct<location_identifiers:array<{_NAMED}>,num_employees_enum:string,website:{_NAMED},"
    "ipo_status:string,rank_org_company:string>,"
    "about_short_description:struct<short_description:string>,"
    f"social_fields:struct<linkedin:{_NAMED},facebook:{_NAMED},twitter:{_NAMED}>,"
    "contact_fields:struct<contact_email:string,phone_number:string>,"
    "semrush_summary:struct<semrush_global_rank:string,semrush_visits_latest_month:string,"
    "identifier:struct<permalink:string,uuid:string>>,"
    "semrush_rank_headline:struct<semrush_visits_mom_pct:string>,"
    f"overview_fields_extended:struct<categories:array<{_NAMED}>,legal_name:string,operating_status:string,"
    f"last_funding_type:string,founded_on:{_NAMED},location_group_identifiers:array<{_NAMED}>>,"
    "advisors_headline:struct<num_current_advisor_positions:string>,"
    f"org_similarity_org_list:array<struct<identifier:{_NAMED}>>,"
    "funding_rounds_summary:struct<num_funding_rounds:string,funding_total:struct<value_usd:string>>,"
    f"acquisitions_list:array<struct<acquiree_identifier:{_NAMED}>>,"
    f"investments_list:array<struct<organization_identifier:{_NAMED}>>,"
    "investments_headline:struct<num_lead_investments:string>,"
    f"investors_list:array<struct<investor_identifier:{_NAMED}>>,"
    "investors_headline:struct<num_lead_investors:string>,"
    "technology_highlights:struct<siftery_num_products:string,builtwith_num_technologies_used:string>,"
    "event_appearances_headline:struct<num_event_appearances:string>>"
)

EMPLOYEES = (
    "entities array<struct<"
    "properties:struct<name:string,linkedin:string,job_levels:array<string>,job_departments:array<string>>,"
    "related_entities:struct<`contact_item.has_contact_item.forward`:struct<entities:array<"
    "struct<properties:struct<job_title:string>>>>>>>"
)

PERSON = (
    f"properties struct<identifier:{_NAMED},title:string,short_description:string,layout_id:string>, "
    "cards struct<"
    f"overview_fields:struct<gender:string,location_group_identifiers:array<{_NAMED}>,"
    f"location_identifiers:array<{_NAMED}>>,"
    "jobs_summary:struct<num_current_jobs:string,num_past_jobs:string>,"
    f"education_image_list:array<struct<school:{_NAMED}>>,"
    f"overview_fields2:struct<linkedin:{_NAMED},twitter:{_NAMED},facebook:{_NAMED}>,"
    "investor_overview_headline:struct<num_current_advisor_jobs:string,num_founded_organizations:string,"
    "num_portfolio_organizations:string,rank_principal_investor:string>>"
)

SITEMAP = "loc string, lastmod string"
