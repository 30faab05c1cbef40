"""The committed CRM sample (61 rows) as literal CSV text, plus helpers that
write it as a raw-layer folder tree. Used by the fixture tests."""

from __future__ import annotations

import os

# The sample rows of the four raw entities.
LEADS = """lead_id,customer_id,lead_name,email,phone,company,deal_value,status,created_at,updated_at,source
L001,C001,John Smith,john.smith@acme.com,+1-555-0101,Acme Corp,50000,closed_won,2024-10-15,2024-11-20,LinkedIn
L002,C002,Sarah Johnson,sarah.johnson@techcorp.com,+1-555-0102,TechCorp,75000,closed_won,2024-09-20,2024-11-18,Referral
L003,C003,Mike Davis,mike.davis@globalinc.com,+1-555-0103,Global Inc,120000,closed_lost,2024-08-10,2024-11-15,Cold Call
L004,C004,Emma Wilson,emma.wilson@innovate.com,+1-555-0104,Innovate Solutions,45000,open,2024-11-01,2024-11-25,Email
L005,C005,David Brown,david.brown@enterprise.com,+1-555-0105,Enterprise Ltd,200000,open,2024-10-05,2024-11-22,LinkedIn
L006,C001,Robert Taylor,robert.taylor@acme.com,,Acme Corp,35000,closed_won,2024-11-10,2024-11-23,Referral
L007,C006,Lisa Anderson,lisa.anderson@startup.io,+1-555-0107,StartUp IO,15000,open,2024-11-12,2024-11-24,Email
L008,C007,James Martin,james.martin@bigtech.com,+1-555-0108,BigTech,550000,closed_won,2024-07-01,2024-11-20,LinkedIn
L009,C008,Jennifer Lee,jennifer.lee@midmarket.com,+1-555-0109,MidMarket Co,85000,closed_lost,2024-09-15,2024-11-19,Cold Call
L010,C009,Christopher White,,+1-555-0110,Finance Plus,95000,open,2024-10-20,2024-11-23,Referral
L011,C010,Patricia Harris,patricia.harris@consulting.com,+1-555-0111,Consulting Group,160000,open,2024-11-05,2024-11-25,LinkedIn
L012,C002,Michael Clark,michael.clark@techcorp.com,+1-555-0112,TechCorp,65000,closed_won,2024-10-25,2024-11-21,Referral
L013,C011,Nancy Young,nancy.young@retail.com,+1-555-0113,Retail Plus,42000,open,2024-11-08,2024-11-24,Email
L014,C012,Daniel Hall,daniel.hall@healthcare.com,,Healthcare Solutions,180000,open,2024-10-30,2024-11-25,LinkedIn
L015,C013,Karen King,karen.king@manufacturing.com,+1-555-0115,Manufacturing Inc,220000,closed_won,2024-06-15,2024-11-20,Cold Call
"""

CUSTOMERS = """customer_id,customer_name,industry,country,city,employee_count,annual_revenue,account_manager,created_at
C001,Acme Corp,Manufacturing,USA,New York,500,50000000,John Doe,2023-01-15
C002,TechCorp,Technology,USA,San Francisco,1200,120000000,Jane Smith,2022-06-20
C003,Global Inc,Consulting,USA,Chicago,800,80000000,Mike Johnson,2023-03-10
C004,Innovate Solutions,Software,USA,Boston,350,35000000,Sarah Lee,2023-09-05
C005,Enterprise Ltd,Finance,USA,New York,2000,200000000,David Chen,2022-11-30
C006,StartUp IO,Technology,USA,Austin,45,4500000,Emma Wilson,2024-02-14
C007,BigTech,Technology,USA,Seattle,5000,500000000,Robert Taylor,2021-05-01
C008,MidMarket Co,Retail,USA,Los Angeles,250,25000000,Lisa Anderson,2023-07-22
C009,Finance Plus,Financial Services,USA,New York,600,60000000,James Martin,2022-12-10
C010,Consulting Group,Consulting,USA,Washington DC,900,90000000,Jennifer Lee,2023-04-18
C011,Retail Plus,Retail,USA,Miami,180,18000000,Christopher White,2023-08-25
C012,Healthcare Solutions,Healthcare,USA,Boston,420,42000000,Patricia Harris,2023-10-12
C013,Manufacturing Inc,Manufacturing,USA,Detroit,750,75000000,Michael Clark,2022-09-03
"""

INTERACTIONS = """interaction_id,customer_id,channel,interaction_date,interaction_time_minutes,outcome,notes
INT001,C001,call,2024-11-20,15,positive,Discussed pricing and timeline
INT002,C001,email,2024-11-18,0,positive,Sent proposal document
INT003,C002,whatsapp,2024-11-19,8,positive,Quick follow-up on implementation
INT004,C002,call,2024-11-15,25,positive,Detailed product demo
INT005,C003,call,2024-11-10,20,negative,Customer concerned about ROI
INT006,C003,email,2024-11-08,0,neutral,Sent case studies
INT007,C004,email,2024-11-22,0,positive,Initial inquiry response
INT008,C004,whatsapp,2024-11-20,12,positive,Answered technical questions
INT009,C005,call,2024-11-25,30,positive,Executive briefing
INT010,C005,email,2024-11-23,0,positive,Contract review
INT011,C006,email,2024-11-24,0,positive,Welcome email sent
INT012,C007,call,2024-11-20,45,positive,Strategic planning session
INT013,C007,email,2024-11-18,0,positive,Sent implementation roadmap
INT014,C008,call,2024-11-19,20,negative,Budget constraints mentioned
INT015,C008,email,2024-11-17,0,neutral,Sent alternative proposal
INT016,C009,call,2024-11-23,15,positive,Follow-up on previous meeting
INT017,C009,whatsapp,2024-11-21,5,positive,Quick status update
INT018,C010,email,2024-11-25,0,positive,Sent pricing information
INT019,C011,call,2024-11-24,18,positive,Discussed timeline
INT020,C012,email,2024-11-22,0,positive,Initial contact
INT021,C013,call,2024-11-20,35,positive,Detailed requirements gathering
INT022,C013,email,2024-11-18,0,positive,Sent technical specifications
INT023,C001,call,2024-11-25,12,positive,Final approval call
INT024,C002,call,2024-11-20,20,positive,Implementation kickoff
INT025,C005,whatsapp,2024-11-24,10,positive,Quick clarification
"""

PRODUCTS = """product_id,product_name,category,base_price,currency,launch_date
P001,Enterprise Suite,Software,50000,USD,2023-01-01
P002,Cloud Analytics,Software,30000,USD,2023-06-15
P003,Security Pro,Software,25000,USD,2023-03-20
P004,Integration Hub,Software,40000,USD,2023-09-10
P005,AI Assistant,Software,35000,USD,2024-01-15
P006,Consulting Services,Services,100,USD,2023-02-01
P007,Training Program,Services,50,USD,2023-05-10
P008,Support Premium,Services,200,USD,2023-04-01
"""

SAMPLE = {"leads": LEADS, "customers": CUSTOMERS, "interactions": INTERACTIONS, "products": PRODUCTS}


def write_bronze(root: str, data: dict[str, str] | None = None) -> str:
    """Write each entity as ``{root}/bronze/{entity}/part-0.csv``; return root."""
    for entity, text in (data or SAMPLE).items():
        d = os.path.join(root, "bronze", entity)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "part-0.csv"), "w") as f:
            f.write(text)
    return root
