"""Term lists and the extraction modes they are written for.

Board A and board B are the two posting sources; where their lists differ, the difference is stated as a rule.
"""

from __future__ import annotations


# Results depend on exactly these terms, their case, order and outer spaces.
TOOLS = (
    "AWS", "MS Access", "Microsoft Access", "Azure", " C ", " C,", "C++", "Cassandra", "CircleCI", "Cloud",
    "Confluence", "Databricks", "Docker", "EMR", "ElasticSearch", "Excel", "Flask", "MLFlow", "Kubeflow", "GCP",
    " Git ", "Github", "Hadoop", "Hive", "Hugging Face", "Informatica", "JIRA", "Java", "Javascript", "Jenkins",
    "Kafka", "Keras", "Kubernetes", "LLMs", "Matlab", "Mongodb", "MySQL", "New Relic", "NoSQL", "Numpy", "Oracle",
    "Outlook", "Pandas", "PostgreSQL", "Postman", "Power BI", "PowerPoint", "PySpark", "Python", "Pytorch",
    "Quicksight", " R ", " R, ", "Redshift", "S3", "SAP", "SAS", "SOAP", "SPSS", "SQL", "SQL Server", "Scala",
    "Scikit-learn", "Snowflake", "Spacy", "Spark", "StreamLit", "Tableau", "Talend", "Tensorflow", "Terraform", "Torch",
    "VBA", " Word ", "XML", "transformer", "CI/CD",
)

# Fixed values.
SOFT_SKILLS = (
    "Accountability", "Accuracy", "Adaptability", "Agility", "Analysis", "Analytical Skills", "Attention to detail",
    "Coaching", "Collaboration", "Collaborative", "Commitment", "Communication", "Communication Skills", "Confidence",
    "Continuous learning", "Coordination", "Creativity", "Critical thinking", "Curiosity", "Decision making",
    "Decision-Making", "Dependability", "Design", "Discipline", "Domain Knowledge", "Empathy", "Enthusiasm",
    "Experimentation", "Flexibility", "Focus", "Friendliness", "Imagination", "Initiative", "Innovation", "Insight",
    "Inspiring", "Integrity", "Interpersonal skills", "Leadership", "Mentorship", "Motivated", "Negotiation",
    "Organization", "Ownership", "Passion", "Persistence", "Planning", "Presentation Skills", "Prioritization",
    "Prioritizing", "Problem-solving", "Professional", "Project Management", "Reliable", "Research", "Resilient",
    "Responsibility", "Responsible", "Sense of Urgency", "Storytelling", "Team Player", "Teamwork", "Time management",
    "Verbal Communication", "Work-Life Balance", "Written Communication", "Written and Oral Communication",
)

# Fixed values.
INDUSTRY_SKILLS = (
    "API Design", "API Development", "Batch Processing", "Big data", "Bioinformatics", "Business Intelligence", "CI/CD",
    "Classification", "Cloud", "Cloud Computing", "Containerization", "Critical Thinking", "Data Analysis",
    "Data Architecture", "Data Cleaning", "Data Extraction", "Data Governance", "Data Ingestion", "Data Integration",
    "Data Manipulation", "Data Mining", "Data Modeling", "Data Pipelines", "Data Security", "Data Visualization",
    "Data Warehousing", "Data Wrangling", "Database Design", "Deep Learning", "DevOps", "Distributed computing", "ETL",
    "Econometrics", "Extract", "Feature Engineering", "Google Cloud", "Kubernetes", "LLMs", "Load (ETL) Processes",
    "Logging", "ML", "Machine Learning", "Mathematics", "Metrics", "Microservices Architecture", "Model Deployment",
    "Model Monitoring", "Monitoring", "NLP", "Natural Language Processing", "Natural Language Understanding",
    "Operations Research", "Problem-Solving Skills", "Project Management", "Report Generation", "Research Skills",
    "Scripting", "Statistical Analysis", "Statistics", "Technical Documentation", "Transform",
    "Understanding of Machine Learning Algorithms",
)

# Fixed values.
EDUCATION = (
    " BS ", " MS ", " BS, ", " MS, ", "Ph.D", "M.S.", "PhD", "graduate", "Bachelor", "Master",
)

# Industry-skill synonyms and the name they are reported under.
SKILL_SYNONYMS = {
    "nlp": "natural language processing",
    "ml": "machine learning",
    "load (etl) processes": "etl",
    "extract": "etl",
    "transform": "etl",
}

# Role terms.
DATA_ANALYST = (
    "Data Analysis", "Data Analytics", "SQL", "Excel", "Tableau", "Power BI", "Python", "R", "Statistics",
    "Data Visualization", "Business Intelligence", "BI", "Data Reporting", "Dashboards", "Data Cleaning",
    "Data Preprocessing", "Data Wrangling", "Exploratory Data Analysis", "EDA", "A/B Testing", "Hypothesis Testing",
    "Statistical Analysis", "Regression Analysis", "Time Series Analysis", "Forecasting", "Data Mining",
    "Data Modeling", "ETL", "Extract Transform Load", "Data Warehousing", "Big Data", "Hadoop", "Spark",
    "Google Analytics", "Segment", "Looker", "Matlab", "Predictive Analytics", "Prescriptive Analytics",
    "Machine Learning", "Algorithms", "Reporting", "Data Interpretation", "Critical Thinking", "Problem Solving",
    "Data Governance", "Data Quality", "Data Metrics", "Data Pipeline", "Database Management", "MySQL", "PostgreSQL",
    "NoSQL", "MongoDB", "Redshift", "Snowflake", "AWS", "Azure", "GCP", "Cloud Computing", "KPI",
    "Key Performance Indicators", "Storytelling with Data", "Ad Hoc Analysis",
)

# Role terms.
DATA_SCIENTIST = (
    "Data Science", "Machine Learning", "Deep Learning", "Neural Networks", "Natural Language Processing", "NLP",
    "Computer Vision", "Supervised Learning", "Unsupervised Learning", "Reinforcement Learning", "Scikit-learn",
    "TensorFlow", "Keras", "PyTorch", "Feature Engineering", "Python", "R", "Matlab", "Data Preprocessing",
    "Data Cleaning", "Data Visualization", "Big Data", "Hadoop", "Spark", "AWS", "Azure", "GCP", "Cloud Computing",
    "Data Pipeline", "Data Warehousing", "SQL", "NoSQL", "Statistics", "Probability", "Linear Algebra", "Calculus",
    "Optimization", "Hypothesis Testing", "A/B Testing", "Data Mining", "Data Wrangling", "Exploratory Data Analysis",
    "EDA", "Predictive Modeling", "Prescriptive Analytics", "Data Analysis", "Analytics", "Business Intelligence", "BI",
    "Data Reporting", "Dashboards", "Statistical Analysis", "AI Algorithms", "Time Series Analysis",
)

# Role terms.
DATA_ENGINEER = (
    "SQL", "ETL", "Extract Transform Load", "Data Warehousing", "Big Data", "Hadoop", "Spark", "Data Pipeline",
    "Data Integration", "Data Lake", "NoSQL", "Database Management", "Data Modeling", "Data Architecture", "Python",
    "Kafka", "Airflow", "Redshift", "Snowflake", "Data Migration", "Data Cleansing", "Data Transformation",
    "Cloud Platforms", "AWS", "Azure", "GCP", "Machine Learning", "Data Visualization", "Business Intelligence", "BI",
    "Data Analytics", "OLAP", "Data Governance", "Data Quality", "API Development", "Scripting", "Data Collection",
    "Data Aggregation", "Data Synchronization", "Metadata Management", "Data Lineage", "Batch Processing",
    "Real-time Processing",
)

# Role terms.
ML_ENGINEER = (
    "Machine Learning", "Deep Learning", "Neural Networks", "Natural Language Processing", "NLP", "Computer Vision",
    "Supervised Learning", "Unsupervised Learning", "Reinforcement Learning", "Scikit-learn", "TensorFlow", "Keras",
    "PyTorch", "Algorithm", "Modeling", "Feature Engineering", "Data Science", "Python", "R", "Matlab",
    "Data Preprocessing", "Data Cleaning", "Data Visualization", "Big Data", "Hadoop", "Spark", "AWS", "Azure", "GCP",
    "Cloud Computing", "Data Pipeline", "Data Warehousing", "SQL", "NoSQL", "Statistics", "Probability",
    "Linear Algebra", "Calculus", "Optimization", "Hyperparameter Tuning", "Cross-Validation", "Model Deployment",
    "API Development", "Scripting",
)

ROLE_TERMS_A = {
    "MACHINE LEARNING ENGINEER": ML_ENGINEER,
    "DATA SCIENTIST": DATA_SCIENTIST,
    "DATA ENGINEER": DATA_ENGINEER,
    "DATA ANALYST": DATA_ANALYST,
}

_ONLY_BOARD_A = {
    "DATA SCIENTIST": {"Statistical Analysis", "AI Algorithms", "Time Series Analysis"},
    "DATA ENGINEER": {"Extract Transform Load"},
}

ROLE_TERMS_B = {
    role: tuple(t for t in terms if t not in _ONLY_BOARD_A.get(role, ()))
    for role, terms in ROLE_TERMS_A.items()
}

# The index each board gives a role.
ROLE_INDEX_A = {"DATA ANALYST": 1, "DATA ENGINEER": 2, "DATA SCIENTIST": 3, "MACHINE LEARNING ENGINEER": 4}
ROLE_INDEX_B = {"MACHINE LEARNING ENGINEER": 1, "DATA ENGINEER": 2, "DATA SCIENTIST": 3, "DATA ANALYST": 4}

# Detail pages look for words, so the free-standing tool "Excel" carries its spaces there.
TOOLS_WORDS = tuple(f" {t} " if t == "Excel" else t for t in TOOLS)

# Parts deleted from employer names, in this order.
NAME_NOISE = (
    "the ", "The ", " and ", "&", " And ", " LLC ", " llc ", " inc ", " Inc", " inc", " LLC", " llc", "-",
    " Limited", " limited", " GmBh", " AG", " ag", ".", " Ltd", " ltd",
)


def lowered(terms: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(t.lower() for t in terms)
