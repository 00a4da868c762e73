"""Words, phrases and patterns. All lists here are fixed values: results depend on their entries and order."""

FOUNDERS_OFFICE = ["founder's office", "founders office", "founder office", "office of the founder", "founder associate", "founder's associate", "founder's team", "founders team"]
CHIEF_OF_STAFF = ["chief of staff"]
DATA_ANALYST = ["data analyst", "analytics analyst", "business data analyst", "bi analyst", "business intelligence analyst", "reporting analyst", "product data analyst", "product analyst", "growth data analyst", "marketing data analyst", "operations data analyst", "analytics associate", "data analyst intern", "junior data analyst", "associate data analyst", "data analysis analyst", "data analytics specialist", "financial data analyst", "finance data analyst", "risk data analyst", "supply chain data analyst", "customer data analyst", "revenue data analyst", "commercial data analyst"]
DATA_SCIENTIST = ["data scientist", "applied data scientist", "product data scientist", "machine learning data scientist", "ml scientist", "machine learning scientist", "research data scientist", "data science associate", "junior data scientist", "associate data scientist", "data scientist intern", "data science intern", "decision scientist", "data science specialist", "data science engineer"]
APPLIED_SCIENTIST_EVIDENCE = ["machine learning", "deep learning", "data science", "statistical", "model development", "modeling", "modelling", "nlp", "natural language processing", "computer vision", "neural network", "ai/ml", "ml model"]
BUSINESS_ANALYST_EVIDENCE = ["analytics", "sql", "power bi", "tableau", "looker", "dashboard", "business intelligence", "data analytics", "reporting"]
BUSINESS_ANALYST_NEGATIVE = ["erp", " requirement gathering", "stakeholder management", "uat ", "brd", " srs"]
STRONG_DATA_EVIDENCE = ["data analysis", "statistical analysis", "statistical modeling", "predictive modeling", "predictive analytics", "machine learning", "supervised learning", "unsupervised learning", "deep learning", "feature engineering", "model development", "model evaluation", "natural language processing", "computer vision", "recommendation system", "causal inference", "data mining", "analytical modeling", "business intelligence", "data science", "hypothesis testing", "time series", "time-series"]
DATA_FIELDS = ["data analytics", "data science", "data & analytics", "data and analytics"]
NON_DATA_TITLES = ["machine learning engineer", "ml engineer", "ai engineer", "software engineer", "backend engineer", "data engineer", "analytics engineer", "mlops engineer", "research engineer", "devops engineer", "research scientist", "data entry", "data entry operator", "data entry executive", "data processing executive", "mis executive", "mis coordinator", "content analyst"]
FRAMED_OTHER_TITLE_RX = r"\b(?:hiring|recruiting|looking\s+for|searching\s+for|seeking|role|position|job\s+title|title|opening|vacancy|designation|join\s+as)\b[^.!?;\n]{0,40}?\b(?:" + "|".join(t.replace(" ", r"\s+") for t in NON_DATA_TITLES) + r")\b"
DATA_ENTRY_RX = r"\b(?:hiring|recruiting|looking\s+for|searching\s+for|seeking|role|position|job\s+title|title|opening|vacancy|designation|join\s+as|operator|clerk|executive|associate)\b[^.!?;\n]{0,40}?\bdata\s*entry\b|\bdata\s*entry\b[^.!?;\n]{0,25}?\b(?:operator|clerk|executive|associate|role|position|opening|vacancy)\b"
NOT_DATA_ENTRY_RX = r"\b(?:not|no|non|without)\s+data\s*entry\b"
PROMO_RX = r"follow|subscrib|stay\s+tuned|join\s+(?:our\s+)?(?:channel|community)|hiring\s+updates|job\s+updates|daily\s+(?:hiring\s+|job\s+)?updates|industry\s+insights|regular\s+.*job\s+updates"
EMPLOYER_SUBJECT_RX = r"\b([A-Z][A-Za-z0-9&.'’\-]*(?:\s+[A-Z][A-Za-z0-9&.'’\-]*){0,2})\s+(?:is|are)\s+(?:(?:also|now|currently|actively|recently|all)\s+)?(?:hiring|recruiting|looking\s+to\s+hire|looking\s+for)\b"
HIRING_SIGNALS = ["hiring", "we're hiring", "we are hiring", "now hiring", "hiring for", "looking for", "we're looking for", "we are looking for", "looking to hire", "opening", "open role", "open position", "job opening", "join our team", "building our team", "team is hiring", "apply", "applications open", "send resume", "send your resume", "send cv", "send your cv", "dm to apply", "referrals", "referrals welcome", "seeking candidates", "seeking"]
VACANCY_LABELS = ["role:", "position:", "job title:", "title:", "opening:", "vacancy:", "designation:", "join as"]
JOB_SEEKER = ["open to work", "hire me", "seeking opportunities", "seeking a role", "seeking founder's office", "open to opportunities"]
JOB_SEEKER_RX = [
    r"\bopen\s+to\s+work\b",
    r"\bopen\s+to\s+opportuniti\w*\b",
    r"\bhire\s+me\b",
    r"\bhiring\s+myself\b",
    r"\bseeking\s+employment\b",
    r"\bon\s+the\s+(?:job\s+hunt|lookout)\b",
    r"\bin\s+the\s+job\s+market\b",
    r"\b(?:i|i'?m|i am)\s+(?:am\s+|'m\s+)?(?:actively\s+|currently\s+)?(?:looking\s+for|seeking|searching\s+for|on\s+the\s+hunt\s+for)\s+(?:a\s+|an\s+|the\s+)?[^;\n]{0,45}?(?:role|positions?|opportunit\w+|jobs?|work|employment)\b",
    r"\blooking\s+for\s+(?:a\s+|an\s+|the\s+)?(?:role|positions?|opportunit\w+|jobs?)\b",
    r"\bseeking\s+(?:a\s+|an\s+|the\s+)?(?:role|positions?|opportunit\w+)\b",
    r"\bactively\s+(?:looking\s+for|seeking)\s+(?:a\s+|an\s+|the\s+)?(?:role|positions?|opportunit\w+|jobs?)\b",
]
EMPLOYER_STRONG_RX = [
    r"\bfor\s+our\s+(?:team|company|startup|org|organization|organisation)\b",
    r"\bfor\s+(?:a\s+|an\s+|the\s+)?(?:[a-z-]+\s+){0,3}(?:startup|company)\b",
    r"\b(?:hiring|recruiting|seeking)\s+for\s+a\s+(?:vanity-priced\s+)?(?:role|position)\b",
    r"\bto\s+join\s+(?:our\s+|the\s+)?(?:team|company|startup|us)\b",
    r"\bto\s+work\s+(?:with|for|alongside)\s+(?:us|our\s+company|our\s+team|the\s+company)\b",
    r"\bi(?:'m| am)\s+hiring\b",
    r"\bwe(?:'re| are)\s+(?:currently\s+|actively\s+)?seeking\b",
    r"\bwe(?:'re| are)\s+hiring\b",
    r"\bwe(?:'re| are)\s+looking\s+to\s+hire\b",
    r"\bwe(?:'re| are)\s+looking\s+for\b",
    r"\bcandidates?\b",
    r"\bapplicants?\b",
    r"\bapply\s+(?:now|here|via|to|below)\b",
    r"\bsend\s+(?:me\s+)?(?:your|us\s+your)?\s*(?:resume|cv)\b",
    r"\bthe\s+(?:role|position)\s+is\s+open\b",
    r"\bwe\s+have\s+(?:an?\s+)?(?:opening|open\s+role|vacancy|available\s+position|position\s+open)\b",
    r"\binterested\s+(?:applicants?|candidates?)\b",
    r"\b(?:we|i)\s+are?\s+recruiting\b",
    r"\bhiring\s+for\s+the\s+(?:role|position|team)\b",
]
EMPLOYER_SUPPORT_RX = [r"\bdm\s+me\b", r"\breach\s+(?:out|me)\b", r"\bcontact\s+me\b", r"\bmessage\s+me\b", r"\binbox\s+me\b", r"\bping\s+me\b", r"\binterested\s+in the\s+opening\b"]
CONGRATULATORY = ["excited to join", "thrilled to announce", "i have joined", "i've joined", "congratulations", "my new role", "starting my new position", "happy to share that i", "delighted to announce"]
INFORMATIONAL = ["things i learned as", "what does a", "salary discussion", "salaries can reach", "role is important for", "lessons from being", "my experience as", "seeking advice", "looking for advice"]
ALWAYS_REJECT_RX = [
    r"\bhiring\s+myself\b",
    r"\bhire\s+me\b",
    r"\b(?:she|he|they)(?:\s+is|\s+are|'s|'re)\s+looking\s+for\s+(?:a\s+|an\s+|the\s+)?[^;\n]{0,40}?(?:role|positions?|opportunit\w+|jobs?|work|employment)\b",
    r"\btalent\s+spotlight\b",
]
INTERNSHIP_RX = r"\b(?:intern(?:ship|ing)?s?|campus\s+hiring)\b"
INDIA_CITIES = [
    "bangalore", "bengaluru", "mumbai", "delhi", "delhi ncr", "gurgaon", "gurugram", "noida", "hyderabad", "pune",
    "chennai", "kolkata", "ahmedabad", "jaipur", "india", "remote - india", "remote india",
    "indore", "coimbatore", "chandigarh", "bhubaneswar", "visakhapatnam", "vizag", "nagpur", "surat", "vadodara",
    "lucknow", "kanpur", "bhopal", "thane", "mysuru", "mysore", "trivandrum", "thiruvananthapuram", "ranchi", "dehradun",
    "guwahati", "amritsar", "agra", "ghaziabad", "navi mumbai", "raipur",
    "karnataka", "maharashtra", "telangana", "tamil nadu", "kerala", "gujarat", "rajasthan", "haryana", "uttar pradesh",
    "west bengal", "andhra pradesh", "madhya pradesh", "odisha", "assam", "chhattisgarh",
]
#: Those of INDIA_CITIES that are states.
INDIA_STATES = ["karnataka", "maharashtra", "telangana", "tamil nadu", "kerala", "gujarat", "rajasthan", "haryana", "uttar pradesh", "west bengal", "andhra pradesh", "madhya pradesh", "odisha", "assam", "chhattisgarh"]
#: Cities and states in the list's order, with one spelling of a city that has two.
PLACE_NAMES = [c for c in INDIA_CITIES if "india" not in c and c != "bangalore"]
NON_INDIA = ["london", "new york", "dubai", "singapore", "toronto", "san francisco", "seattle", "boston", "chicago", "los angeles", "berlin", "paris", "amsterdam", "tokyo", "sydney", "melbourne", "united states", "united kingdom", "canada", "australia", "germany", "france", "netherlands", "japan"]
NON_INDIA_RX = [r"£\s*\d[\d,]*", r"[\w.\-]+\.co\.uk\b"]
KNOWN_EMPLOYERS = ["indmoney", "zerodha", "groww", "flipkart", "phonepe", "paytm", "razorpay", "swiggy", "zomato", "oyo", "nykaa", "delhivery", "meesho", "lenskart", "mamaearth", "dream11", "freshworks", "zoho", "browserstack", "postman", "urban company", "infosys", "tcs", "wipro", "hcl", "hcltech", "tech mahindra", "tata", "reliance", "jio", "adani"]
AGGREGATOR_RX = [
    r"\bhiring alert(s)?\b.*(?:companies|startups|roles?|positions?|jobs?|roundup|list|\d+\s+(?:roles?|companies|startups))",
    r"\bjob alert(s)?\b.*(?:companies|startups|roles?|positions?|jobs?|roundup|list|\d+\s+(?:roles?|companies|startups))",
    r"\b(?:jobs?|hiring)\s+(?:roundup|digest)s?\b",
    r"\b(?:weekly\s+)?roundup\b",
    r"\bcurated\s+(?:jobs|roles?|opportunities)\b",
    r"\bjob\s+board\b",
    r"\b(?:jobs?|career(?:s)?)\s+list\b",
    r"\broles?\s+hiring\s+right\s+now\b",
    r"\b\d+\s+(?:roles?|positions?)\s+hiring\b",
    r"\b\d+\s+(?:companies|startups)\s+hiring\b",
    r"\bhere\s+are\s+\d+\s+(?:roles?|jobs?|positions?)\b",
    r"\bcompanies\s+are?\s+hiring\b",
    r"\b(?:jobs?|roles?)?\s*opportunities?\s+roundup\b",
    r"\bbatch\s+of\s+\d+\s+roles?\b",
    r"\broles?\s+(?:i|we)\s+(?:went\s+through|reviewed|found|covered|spotted)\b",
    r"\bhere\s+are\s+(?:the\s+)?roles?\b",
    r"\b(?:this|next)\s+week'?s?\s+(?:job|hiring|opportunit\w+|roles?)(?:s|roundup)?\b",
    r"\bmass\s+hiring\b",
    r"\bbatch\s*:\s*20\d{2}",
    r"\bfollow\s+for\s+daily\s+(?:job|hiring|internship)",
    r"\bfor\s+my\s+friends?'?\s+compan",
    r"\bmultiple\s+open\s+roles?\b",
    r"\broles?\s+across\s+(?:multiple\s+)?(?:companies|startups)\b",
    r"\bmultiple\s+companies\s+(?:are\s+)?hiring\b",
    r"\bhiring\s+across\s+(?:multiple\s+)?(?:companies|startups)\b",
    r"\bi\s+found\s+these\s+jobs?\b",
    r"\bjob\s+(?:opportunities|listings?)\s+roundup\b",
    r"\b\d{2,}\s+roles?\b",
    r"\b\d+\s+fresh\s+roles?\b",
    r"\b(?:founder'?s\s+office|chief\s+of\s+staff)\s+(?:&|and)?\s*(?:openings?|roles?)\s+in\s+india\b",
    r"\b(?:openings?|roles?)\s+in\s+india\s*[\(-]\s*(?:last\s+\d+\s+hours?|\d+\s+fresh)\b",
    r"\bfresh\s+roles?\s+for\s+anyone\b",
    r"\btop\s+(?:jobs?|roles?|positions?)\s+in\b",
    r"\bfind\s+here\s*:\s*https?://",
]
PAY_TO_APPLY_RX = [r"\bapplication\s+fee\b", r"\bregistration\s+fee\b", r"\btraining\s+fee\b", r"\bsecurity\s+deposit\b", r"\bprocessing\s+fee\b", r"\bpay\s+to\s+apply\b", r"\bpaid\s+placement\b", r"\bguaranteed\s+placement\b", r"\b100\s*%\s+placement\b", r"\bguaranteed\s+job\b", r"\bpayment\s+required\s+before\s+joining\b", r"\bpaid\s+certification\s+sold\s+as\s+internship\b", r"\bcourse\s+disguised\s+as\s+internship\b", r"\binternship\s+requires\s+payment\b", r"\bfunding\s+required\b"]
MULTI_EMPLOYER_STOPWORDS = ["we", "we're", "i", "i'm", "it", "they", "you", "he", "she", "india", "bangalore", "bengaluru", "mumbai", "delhi", "hyderabad", "pune", "chennai", "now", "our", "this", "that"]
_FO = r"(?:founder'?s\s+office|chief\s+of\s+staff)"
_LABEL = r"\b(?:\*?\s*(?:role|position|job\s+title|title|opening|open\s+(?:role|position)|vacancy|designation)\s*\*?)\s*[:|–—*-]+\s*"
FO_STRONG_RX = [
    r"\b(?:hiring|recruiting|looking\s+for|searching\s+for|seeking)\b(?:[:|–—*-]+|\s+)+(?:a|an|for|the|as|of)?\s*[^.!?;\n]{0,25}?" + _FO + r"\b",
    r"\bhiring\s+for\b[^.!?;\n]{0,20}?" + _FO + r"\b",
    _LABEL + _FO + r"\b",
    r"\bjoin(?:ing)?\s+(?:the\s+)?" + _FO + r"\b",
    r"\b" + _FO + r"\s+(?:associate|executive|analyst|lead|head|manager|officer)\b",
    r"\b" + _FO + r"\s+(?:associate\s+)?(?:is\s+)?(?:open|opening|position|vacancy)\b",
    r"\bfor\s+the\s+role\s+of\s+" + _FO + r"\b",
    _LABEL + r"(?:founder'?s\s+team|founders\s+team)(?:\s*/\s*business\s+operations)?\b",
]
FO_WEAK_RX = [
    r"\b" + _FO + r"\s+(?:role|experience|mindset|environment|team|setting|background|context|function|work|type)\b",
    r"\b" + _FO + r"\s+(?:experience|mindset|skills?|background|prior)\s+(?:preferred|required|a\s+plus|needed)\b",
    r"\b(?:experience|prior|background)\s+(?:in|of)\s+(?:the\s+)?" + _FO + r"\b",
    r"\bwork(?:ing)?\s+(?:in|within|at|under)\s+the\s+founder'?s\s+office\b",
    r"\b(?:in|within|under)\s+the\s+founder'?s\s+office\b",
    r"\bworked\s+(?:in|within|at|under)\s+the\s+founder'?s\s+office\b",
    r"\bsuch\s+as\b[^.!?\n]{0,100}" + _FO + r"\b",
    r"\bexposure\s+to\b[^.!?\n]{0,80}" + _FO + r"\b",
    r"\bfolks\s+from\s+(?:the\s+)?" + _FO + r"\b",
    r"\bwork\s+(?:closely\s+)?with\s+the\s+chief\s+of\s+staff\b",
    r"\bmanager\s*[–—:|/-]\s*ceo'?s?\s+office\b",
    r"\brecruiting\s+for\s+(?:an?\s+)?executive\s+assistant\b",
    r"\bexecutive\s+assistant\s+to\s+(?:director|ceo|founder|chairperson|chairman|president|manager|partner)\b",
    r"\bexperience\s+(?:working\s+)?with\s+founders?\b",
    r"\b(?:high[- ]ownership|impactful|hands-on)\s+.{0,50}?role\b",
    r"\bbusiness\s+operations\b",
    r"\bfounder'?s\s+team\b",
]
_DATA = r"(?:data\s+analyst|data\s+scientist|business\s+analyst|analytics\s+associate|decision\s+scientist|(?:bi|product|reporting)\s+analyst|(?:ml|machine\s+learning)\s+scientist)"
DATA_STRONG_RX = [
    r"\b(?:hiring|recruiting|looking\s+for|searching\s+for|seeking)\b(?:[:|–—*-]+|\s+)+(?:a|an|for|the|as|of)?\s*[^.!?;\n]{0,25}?" + _DATA + r"\b",
    r"\bhiring\s+for\b[^.!?;\n]{0,20}?" + _DATA + r"\b",
    _LABEL + _DATA + r"\b",
    r"\bjoin(?:ing)?\s+(?:the\s+|our\s+|as\s+(?:a\s+)?)?" + _DATA + r"\b",
    r"\b" + _DATA + r"\s+(?:is\s+)?(?:open|opening|position|vacancy)\b",
    r"\bfor\s+the\s+role\s+of\s+" + _DATA + r"\b",
]
DATA_WEAK_RX = [
    r"\bunderstand(?:s|ing)?\s+(?:data|analytics)\b",
    r"\bknowledge\s+of\s+(?:data|analytics|python|sql|machine\s+learning)\b",
    r"\bwith\s+(?:python|sql|ml|machine\s+learning|analytics)\s+experience\b",
    r"\b(?:data|analytics)\s+(?:experience|mindset|skills?|background)\s+(?:preferred|required|a\s+plus|needed|must)\b",
    r"\bexperience\s+(?:in|of|with)\s+(?:data|analytics)\b",
    r"\brequir(?:es|ing)\s+(?:analytics|data\s+analysis)\b",
    r"\bmarketing\s+role\b[^.!?\n]{0,60}\banalytics\b",
    r"\bsoftware\s+engineer\b",
    r"\bdata\s+entry\b",
    r"\bwork\s+(?:closely\s+)?with\s+the\s+data\s+team\b",
    r"\bcollaborat\w+\s+with\s+(?:data|analytics)\b",
]
GEO_TRAPS_RX = r"(?i)\b(?:indian\s+ocean|british\s+indian\s+ocean\s+territory|west\s+indies|american\s+indian|native\s+indian|indian\s+wells|indian\s+river|indian\s+head|indian\s+trail|indian\s+springs|indian\s+hills)\b"
GEO_DECISIVE_RX = r"(?i)(₹|\bINR\b|\bRs\.?\s*\d|\bLPA\b|\blakhs?\b|\bcrores?\b|\+91[\s-]?\d|\bPAN[\s-]India\b|\bIIT\b|\bIIM\b|\bBITS\s+Pilani\b)"
GEO_PLACES_RX = r"(?i)\b(" + "|".join(x.replace(" ", r"\s+") for x in ["india", "indias", "indian", "bharat", "bombay", "new delhi", "ncr", "madras", "calcutta", *(c for c in INDIA_CITIES if "india" not in c)]) + r")\b"
GEO_COMPANY_FORM_RX = r"(?i)\b(pvt\.?\s*ltd|private\s+limited)\b"
GEO_NEIGHBOURS_RX = r"(?i)\b(?:pakistan|bangladesh|sri\s+lanka|nepal|bhutan|lahore|karachi|islamabad|rawalpindi|dhaka|chittagong|colombo|kathmandu)\b"
GEO_FOREIGN_RX = r"(?i)\b(?:pakistan|bangladesh|sri\s+lanka|nepal|bhutan|maldives|afghanistan|united\s+states|u\.?s\.?a|usa|canada|mexico|brazil|argentina|colombia|chile|latin\s+america|united\s+kingdom|u\.?k\.?|england|scotland|ireland|germany|france|spain|italy|portugal|netherlands|belgium|switzerland|austria|poland|czech|hungary|romania|bulgaria|greece|sweden|norway|denmark|finland|t[üu]rkiye|turkey|israel|egypt|nigeria|kenya|south\s+africa|ghana|morocco|uae|united\s+arab\s+emirates|dubai|abu\s+dhabi|saudi|qatar|bahrain|kuwait|oman|china|japan|korea|vietnam|thailand|indonesia|malaysia|singapore|philippines|australia|new\s+zealand|liechtenstein|luxembourg|estonia|lithuania|latvia)\b"
AD_RX = r"(?i)(?:jobs?|hiring|careers?|naukri|foundit|shine|timesjobs|freshersworld|iimjobs|cutshort|\bapna\b|placements?|vacanc(?:y|ies)|alerts?|updates?|referrals?|job\s*search|hiring\s*hub|job\s*hub|talent\s*hub|pagaar|careerbee)"
GENERIC_MODIFIERS_RX = r"(?i)\b(india|indian|official|page|hub|alerts?|updates?|portal|point|zone|adda|bhaiya|24x7|for\s+you|jobs?|careers?|hiring)\b"
AGENCY_RX = r"(?i)(\bconsult(?:ing|ancy|ants?)\b|\brecruit(?:ers?|ment)\b|\bstaffing\b|\btalent\s+solutions?\b|\bhr\s+services\b|\bplacement\b)"
CLIENT_RX = r"(?i)\b(?:our|my|a|one\s+of\s+our)\s+clients?\b"
UNDISCLOSED_RX = r"(?i)\b(?:confidential\s+client|undisclosed|stealth\s+startup|client\s+name)\b"
SINGULAR_VOICE_RX = r"(?i)(\bi(?:'m|m|\s+am)\s+hiring\b|\bmy\s+team\s+is\s+(?:hiring|looking\s+for)\b|\bhiring\s+for\s+my\s+team\b|\bjoin\s+my\s+team\b|\bcontact\s+me\s+(?:to\s+)?apply\b|\bdm\s+(?:me\s+)?[A-Z][a-z]+\b)"
PLURAL_VOICE_RX = r"(?i)(\bwe(?:'re|re|\s+are)\s+hiring\b|\bwe\s+are\s+looking\s+for\b|\bjoin\s+our\s+team\b)"
NAMED_CUE_RX = r"(?i)(\bdm\s+[A-Z][a-z]+\b|\bcontact\s+[A-Z][a-z]+\b)"
POSTER_SINGULAR_RX = r"(?i)(\bi(?:'m|m|\s+am)\s+(?:hiring|recruiting)\b|\bmy\s+team\s+is\s+hiring\b|\bcontact\s+me\s+(?:to\s+)?apply\b|\breach\s+out\s+to\s+me\b|\bdm\s+me\b|\bi(?:'m|m|\s+am)\s+the\s+(?:founder|ceo|co-founder|head)\b)"
POSTER_PLURAL_RX = r"(?i)(\bwe(?:'re|re|\s+are)\s+(?:hiring|recruiting|looking\s+for)\b|\bjoin\s+(?:us|our\s+team)\b)"
RECRUITER_RX = r"(?i)\b(?:recruit(?:er|ing|ment)|talent\s+(?:acquisition|team|partner)|hiring\s+manager|hr\s+(?:manager|executive)|people\s+team|talent\s+team|human\s+resources)\b"
VAGUE_ROLE_RX = r"(?i)(multiple\s+(?:openings?|roles?|positions?|vacancies|jobs?)|various\s+(?:roles?|positions?|openings?|jobs?)|several\s+(?:roles?|positions?|openings?)|\bhiring\s+now\b|management\s+roles?|open\s+roles?|job\s+openings?)"
MISSING_COMPANY = ["", "unclear", "n/a", "na", "none", "unknown", "undisclosed", "our client", "confidential client", "client undisclosed", "confidential", "stealth"]
MISSING_ROLE = ["", "unclear", "n/a", "na", "none", "unknown"]
PERSONAL_DOMAINS = ["gmail.com", "googlemail.com", "yahoo.com", "ymail.com", "hotmail.com", "outlook.com", "live.com", "msn.com", "icloud.com", "me.com", "proton.me", "protonmail.com", "zoho.com", "aol.com", "gmx.com", "mail.com", "rediffmail.com", "rediff.com", "yandex.com", "inbox.com", "example.com", "email.com", "mailinator.com", "yopmail.com", "tempmail.com"]
NON_CONTACT_LOCALS = ["noreply", "no-reply", "donotreply", "do-not-reply", "unsubscribe"]
APPLICATION_PURPOSE_RX = r"(?i)\b(?:send|share|forward|drop|mail|email|submit)\s+(?:me\s+|us\s+)?(?:your|their|the|updated\s+)?\s*(?:resume|resumes|cv|profile|application|details)\b|\bapply\s+(?:at|to|via|on|here|now)?\s*:?|\binterested\s+(?:candidates?|applicants?)\b[^.\n]{0,60}\b(?:send|share|mail|email|resume|cv)\b|\bresume\s+(?:at|to)\b|\bcv\s+(?:at|to)\b|\bto\s+apply\b[^.\n]{0,40}\b(?:email|mail|send)\b"
#: Public mailboxes and their ranks; any other has 99.
MAILBOX_RANKS = {"careers": 1, "career": 1, "hiring": 2, "jobs": 3, "talent": 4, "recruit": 5, "recruiting": 5, "recruitment": 5, "recruiter": 5, "contact": 6, "hello": 6, "info": 6, "apply": 6, "hr": 6, "work": 6, "join": 6, "team": 6}
ROLE_CUE_RX = r"(?i)founder'?s\s+office|founders?\s+office|chief\s+of\s+staff|founder'?s\s+associate|office\s+of\s+the\s+founder|ceo'?s?\s+office|data\s+scientist|data\s+science|applied\s+scientist|ml\s+scientist|machine\s+learning\s+scientist|data\s+analyst|analytics\s+analyst|business\s+data\s+analyst|bi\s+analyst|business\s+intelligence\s+analyst|reporting\s+analyst|product\s+(?:data\s+)?(?:analyst|scientist)|growth\s+data\s+analyst|marketing\s+data\s+analyst|operations\s+data\s+analyst|analytics\s+associate|business\s+analyst"
HIRING_CUE_RX = r"(?i)\bhiring\b|\bapply\b|\bopening\b|\bjoin\b|\brole\b|\bposition\b"
DETAIL_CUE_RX = r"(?i)\b\d+\s*(?:years?|yrs?|lpa|lakhs?|crore)|\bexperience\b|\bctc\b|\bcompensation\b|\bfull[\s‑\-–—]*time\b|\bhybrid\b|\bin[\s‑\-–—]*office\b|\bremote\b|\bdeadline\b|\bprobation\b|\bbengaluru\b|\bbangalore\b|\bmumbai\b|\bdelhi\b|\bgurgaon\b|\bgurugram\b|\bnoida\b|\bhyderabad\b|\bpune\b|\bchennai\b|\bkolkata\b|\bahmedabad\b|\bjaipur\b|\bindore\b|\bthane\b|\bindia\b"
EMAIL_RX = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL_RX = r"https?://[^\s<>\]\)\"']+"
GOOGLE_FORM_RX = r"(?i)https?://(?:www\.)?(?:docs\.google\.com/forms/[^\s<>\]\)\"']+|forms\.gle/[^\s<>\]\)\"']+)"
URL_TAIL = ".,;:!?*)]\"'"
APPLY_CUE_RX = r"(?i)\b(?:apply|application|applications?|register(?:ing|ation)?|fill\s+(?:up\s+|out\s+)?(?:this\s+|the\s+)?form|submit\s+(?:your\s+)?(?:resume|cv|profile|application)|to\s+apply)\b"
NON_COMPANY = ["we", "i", "it", "they", "you", "he", "she", "our", "my", "the", "a", "an", "this", "that", "re", "ve", "ll", "d", "s", "m", "at", "for", "in", "on", "to", "and", "or", "is", "are", "hiring", "jobs", "job", "who", "what", "which", "unclear", "n/a", "na", "none", "unknown"]
NAME_CONNECTORS = ["of", "and", "the", "&", "de", "la", "van", "der", "al"]
GENERIC_DESCRIPTORS = ["a", "an", "the", "fast", "growing", "leading", "top", "new", "well", "known", "reputed", "promising", "emerging", "scaling", "bootstrapped", "funded", "backed", "financing", "seeded", "venture", "ventures", "early", "stage", "fastest", "startup", "startups", "company", "companies", "brand", "brands", "ai", "business", "businesses", "firm", "firms", "studio", "studios", "agency", "agencies", "fintech", "medtech", "healthtech", "edtech", "insurtech", "clean", "deep", "saas", "tech", "technology", "technologies", "platform", "product", "products", "service", "services", "industry", "industries", "digital", "organisation", "organization", "team", "entity", "our", "my", "your", "their", "its", "his", "her", "pvt", "private", "limited", "ltd", "llp", "llc", "inc", "corp", "works", "labs", "group", "systems", "solutions"]
PLACEHOLDER_COMPANIES = ["india", "indian", "bangalore", "bengaluru", "mumbai", "delhi", "new delhi", "hyderabad", "pune", "chennai", "kolkata", "ahmedabad", "jaipur", "gurgaon", "gurugram", "noida", "remote", "remote india", "remote - india", "india and global", "global", "worldwide"]
JOIN_COMPANY_RX = r"\b[Jj]oin\s+([A-Za-z0-9&.'\-]+(?:[ \t]+[A-Za-z0-9&.'\-]+){0,3})"
IS_HIRING_RX = r"\b([A-Z][A-Za-z0-9&\.\-]*(?:[ \t]+[A-Z][A-Za-z0-9&\.\-]*){0,3})\s+(?i:is|are)\s+(?i:hiring|looking\s+for)\b"
AT_COMPANY_RX = r"\b(?:at|join)\b ([A-Z][a-zA-Z0-9\s&]+?)(?:\.|,|\n|$| hiring| is looking)"
HIRING_AT_RX = r"(?i)\bhiring\s+(?:for\s+)?(?:[^.]{1,60}?\b)?at\s+([A-Z][A-Za-z0-9&\.\-]*(?:[ \t]+[A-Z][A-Za-z0-9&\.\-]*){0,3})\b"
HIRING_FOR_RX = r"(?i)\b([A-Z][A-Za-z0-9&\.\-]*(?:[ \t]+[A-Z][A-Za-z0-9&\.\-]*){0,3})\s+hiring\s+for\b"
EXACT_ROLE_RX = r"(?i)(chief\s+of\s+staff|founder['’]?s?\s+office|founders?\s+office|founder['’]?s?\s+associate|founder\s+associate|office\s+of\s+the\s+founder|data\s+scientist|data\s+science\s+associate|data\s+science\s+specialist|data\s+science\s+engineer|decision\s+scientist|applied\s+(?:data\s+scientist|scientist)|product\s+data\s+scientist|research\s+data\s+scientist|machine\s+learning\s+(?:data\s+scientist|scientist)|ml\s+scientist|junior\s+data\s+scientist|associate\s+data\s+scientist|data\s+science\s+intern|data\s+analyst|analytics\s+analyst|business\s+data\s+analyst|bi\s+analyst|business\s+intelligence\s+analyst|reporting\s+analyst|product\s+data\s+analyst|product\s+analyst|growth\s+data\s+analyst|marketing\s+data\s+analyst|operations\s+data\s+analyst|analytics\s+associate|financial\s+data\s+analyst|finance\s+data\s+analyst|risk\s+data\s+analyst|supply\s+chain\s+data\s+analyst|customer\s+data\s+analyst|revenue\s+data\s+analyst|commercial\s+data\s+analyst|data\s+analy(?:sis|tics)\s+analyst|data\s+analytics\s+specialist|junior\s+data\s+analyst|associate\s+data\s+analyst|business\s+analyst)\b"
SENIORITY_RX = r"(?i)(senior|sr\.?|junior|jr\.?|lead|principal|staff)\s*$"
MANAGER_CONTEXT_RX = r"(?i:reports?\s+(?:directly\s+)?to\s+|works?\s+(?:directly\s+)?with\s+|working\s+(?:directly\s+)?with\s+|will\s+report\s+(?:directly\s+)?to\s+|will\s+partner\s+with\s+|in\s+partnership\s+with\s+|reach\s+out\s+to\s+|contact\s+person:\s*|point\s+of\s+contact:\s*|hiring\s+manager:\s*|contact\s+)([A-Z][A-Za-z'\-]+(?:\s+[A-Z][A-Za-z'\-]+){1,2})"
COMPANY_LIKE_RX = r"(?i)\b(?:LLP|Pvt|Private|Limited|Ltd|Inc|LLC|Corp|Co\.|&|and\s+Co)\b"
NAMED_LEADER_RX = r"\b(?:my|our)\s+(?:co[\s\-]*founder|founder|ceo|chief\s+executive|managing\s+director)\s+([A-Z][a-zA-Z'\-]+(?:\s+[A-Z][a-zA-Z'\-]+){0,2})"
SIGNATURE_RX = r"([A-Z][A-Za-z'\-]+(?:[ \t]+[A-Z][A-Za-z'\-]+){1,2})[ \t]*[|｜][ \t]*[^|\n]{2,60}?[ \t]*(?:\n|$)"
SIGNOFF_RX = r"([A-Z][A-Za-z'\-]+(?:[ \t]+[A-Z][A-Za-z'\-]+){1,2})\s*\n\s*(?:(?:Sr\.?|Senior|Junior|Lead|Head|Chief|AVP|VP)\s+)?(?:HR|Human\s+Resources|Talent\s+Acquisition|Recruit(?:er|ment|ing)|People(?:\s+(?:Operations|Team|Ops))?|Hiring\s+Manager)[A-Za-z \t&\-]{0,30}"
SIGNATURE_TITLE_RX = r"(?i)\b(?:talent|recruit(?:er|ment|ing)|human\s+resources|hr|hiring|people(?:\s+(?:team|ops|operations))?|staffing)\b"
SIGNATURE_CONTACT_RX = r"@|\+?\d[\d\s\-]{7,}\d|📞|📧"
#: Each word has a capital first and a small letter later.
PROPER_NAME_RX = r"^(?:['’-]*[A-Z][A-Za-z'’\-]*[a-z][A-Za-z'’\-]*)(?: ['’-]*[A-Z][A-Za-z'’\-]*[a-z][A-Za-z'’\-]*){0,2}$"
AUTHOR_HIRING = ["i'm hiring", "we're hiring", "i am hiring", "my team", "our team"]
PROFILE_RX = r"https?://(?:www[.]|[a-z]{2,3}[.])?linkedin[.]com/in/[A-Za-z0-9_-]{2,}"

#: Names of places in a text, in the order in which they are looked for, and how each place is written.
CANONICAL_PLACES = [
    ("bangalore", "Bengaluru, Karnataka, India"), ("bengaluru", "Bengaluru, Karnataka, India"), ("gurgaon", "Gurugram, Haryana, India"), ("gurugram", "Gurugram, Haryana, India"), ("noida", "Noida, Uttar Pradesh, India"),
    ("delhi", "New Delhi, India"), ("new delhi", "New Delhi, India"), ("mumbai", "Mumbai, Maharashtra, India"), ("bombay", "Mumbai, Maharashtra, India"), ("hyderabad", "Hyderabad, Telangana, India"), ("pune", "Pune, Maharashtra, India"),
    ("chennai", "Chennai, Tamil Nadu, India"), ("kolkata", "Kolkata, West Bengal, India"), ("ahmedabad", "Ahmedabad, Gujarat, India"), ("jaipur", "Jaipur, Rajasthan, India"), ("tirupur", "Tirupur, Tamil Nadu, India"), ("tiruppur", "Tirupur, Tamil Nadu, India"), ("tirpur", "Tirupur, Tamil Nadu, India"),
]
#: Words that show that remote work may be done from India.
REMOTE_INDIA_MARKS = ["india", "noida", "bangalore", "bengaluru", "mumbai", "pune", "hyderabad", "chennai", "delhi", "gurgaon", "gurugram", "lpa", "inr", "rupees", "lakh", "kolkata"]
#: Parts of an address that tell the kind of a page, in the order in which they are looked for; its source and tier.
PAGE_KINDS = [
    ("careers", ["/careers", "/career", "/join", "/jobs", "/hiring", "/work-with-us", "/job", "/vacanc", "/position"], "company_careers_page", 1),
    ("contact", ["/contact", "/contacts", "/contact-us", "/enquiry"], "company_contact_page", 1),
    ("about", ["/team", "/people", "/about", "/leadership"], "company_site_page", 2),
    ("site", [], "company_website", 2),
]
#: Pages of a company's site that may name a contact.
CONTACT_PATHS = ["/careers", "/jobs", "/join", "/hiring", "/contact", "/contact-us", "/about", "/team"]
