"""Fixed values the results depend on: codes, uuids and the dictionaries between the two record systems."""

# Source encounter type, target type id ("-" = none), target type uuid.
ENCOUNTER_TYPES = """
1 7 de78a6be-bfc5-4634-adc3-5f1a280455cc
2 8 a0034eee-1940-4e35-847f-97537a35d05e
3 7 de78a6be-bfc5-4634-adc3-5f1a280455cc
4 8 a0034eee-1940-4e35-847f-97537a35d05e
5 4 17a381d1-7e29-406a-b782-aa903b963c28
6 4 17a381d1-7e29-406a-b782-aa903b963c28
7 4 17a381d1-7e29-406a-b782-aa903b963c28
8 4 17a381d1-7e29-406a-b782-aa903b963c28
9 4 17a381d1-7e29-406a-b782-aa903b963c28
10 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
11 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
13 300 e360f35f-e496-4f01-843b-e2894e278b5b
14 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
15 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
16 6 d1059fb9-a079-4feb-a749-eedd709ae542
17 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
18 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
19 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
20 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
21 31 1495edf8-2df2-11e9-b210-d663bd873d93
22 303 54df6991-13de-4efc-a1a9-2d5ac1b72ff8
23 303 54df6991-13de-4efc-a1a9-2d5ac1b72ff8
26 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
31 2 2bdada65-4c72-4a48-8730-859890e25cee
32 14 3ee036d8-7c13-4393-b5d6-036f2fe45126
33 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
34 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
43 8 a0034eee-1940-4e35-847f-97537a35d05e
44 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
46 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
47 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
55 278 b402d094-bff3-4b31-b167-82426b4e3e28
56 270 5c1ecaf1-ec25-46b7-9b5e-ee7fe44f03cf
67 8 a0034eee-1940-4e35-847f-97537a35d05e
69 8 a0034eee-1940-4e35-847f-97537a35d05e
70 255 70a0158e-98f3-400b-9c90-a13c84b72065
80 252 160fcc03-4ff5-413f-b582-7e944a770bed
81 31 1495edf8-2df2-11e9-b210-d663bd873d93
86 247 e24209cc-0a1d-11eb-8f2a-bb245320c623
96 278 b402d094-bff3-4b31-b167-82426b4e3e28
105 7 de78a6be-bfc5-4634-adc3-5f1a280455cc
106 8 a0034eee-1940-4e35-847f-97537a35d05e
110 6 d1059fb9-a079-4feb-a749-eedd709ae542
111 30 e1406e88-e9a9-11e8-9f32-f2801f1b9fd1
114 8 a0034eee-1940-4e35-847f-97537a35d05e
115 11 01894f88-dc73-42d4-97a3-0929118403fb
116 2 2bdada65-4c72-4a48-8730-859890e25cee
117 8 a0034eee-1940-4e35-847f-97537a35d05e
119 8 a0034eee-1940-4e35-847f-97537a35d05e
120 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
121 30 e1406e88-e9a9-11e8-9f32-f2801f1b9fd1
125 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
126 7 de78a6be-bfc5-4634-adc3-5f1a280455cc
127 8 a0034eee-1940-4e35-847f-97537a35d05e
129 303 54df6991-13de-4efc-a1a9-2d5ac1b72ff8
131 277 dfcbe5d0-1afb-48a0-8f1e-5e5988b11f15
132 22 975ae894-7660-4224-b777-468c2e710a2a
133 51 706a8b12-c4ce-40e4-aec3-258b989bf6d3
134 38 c4a2be28-6673-4c36-b886-ea89b0a42116
137 7 de78a6be-bfc5-4634-adc3-5f1a280455cc
138 8 a0034eee-1940-4e35-847f-97537a35d05e
140 303 54df6991-13de-4efc-a1a9-2d5ac1b72ff8
144 8 a0034eee-1940-4e35-847f-97537a35d05e
146 247 e24209cc-0a1d-11eb-8f2a-bb245320c623
147 247 e24209cc-0a1d-11eb-8f2a-bb245320c623
153 8 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
157 2 2bdada65-4c72-4a48-8730-859890e25cee
158 8 a0034eee-1940-4e35-847f-97537a35d05e
162 8 a0034eee-1940-4e35-847f-97537a35d05e
163 8 a0034eee-1940-4e35-847f-97537a35d05e
168 252 160fcc03-4ff5-413f-b582-7e944a770bed
176 8 a0034eee-1940-4e35-847f-97537a35d05e
181 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
182 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
186 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
196 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
203 24 7df67b83-1b84-4fe2-b1b7-794b4e9bfcc3
208 243 86709cfc-1490-11ec-82a8-0242ac130003
209 243 86709cfc-1490-11ec-82a8-0242ac130003
210 278 b402d094-bff3-4b31-b167-82426b4e3e28
211 278 b402d094-bff3-4b31-b167-82426b4e3e28
212 8 a0034eee-1940-4e35-847f-97537a35d05e
213 8 a0034eee-1940-4e35-847f-97537a35d05e
214 32 5cf0124e-09da-11ea-8d71-362b9e155667
220 33 5cf00d9e-09da-11ea-8d71-362b9e155667
221 6 d1059fb9-a079-4feb-a749-eedd709ae542
224 5 de1f9d67-b73e-4e1b-90d0-036166fc6995
227 4 17a381d1-7e29-406a-b782-aa903b963c28
233 9 415f5136-ca4a-49a8-8db3-f994187c3af6
234 10 bcc6da85-72f2-4291-b206-789b8186a021
235 11 01894f88-dc73-42d4-97a3-0929118403fb
236 12 82169b8d-c945-4c41-be62-433dfd9d6c86
237 13 5feee3f1-aa16-4513-8bd0-5d9b27ef1208
238 14 3ee036d8-7c13-4393-b5d6-036f2fe45126
239 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
240 16 7c426cfc-3b47-4481-b55f-89860c21c7de
242 21 e87aa2ad-6886-422e-9dfd-064e3bfe3aad
243 22 975ae894-7660-4224-b777-468c2e710a2a
247 - e24209cc-0a1d-11eb-8f2a-bb245320c623
248 24 7df67b83-1b84-4fe2-b1b7-794b4e9bfcc3
249 29 7dffc392-13e7-11e9-ab14-d663bd873d93
250 28 9bc15e94-2794-11e8-b467-0ed5f89f718b
251 30 e1406e88-e9a9-11e8-9f32-f2801f1b9fd1
252 243 86709cfc-1490-11ec-82a8-0242ac130003
253 306 bfbb5dc2-d3e6-41ea-ad86-101336e3e38f
257 7 de78a6be-bfc5-4634-adc3-5f1a280455cc
260 8 a0034eee-1940-4e35-847f-97537a35d05e
261 31 1495edf8-2df2-11e9-b210-d663bd873d93
262 50 291c0828-a216-11e9-a2a3-2a2ae2dbcce4
263 38 c4a2be28-6673-4c36-b886-ea89b0a42116
264 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
265 14 3ee036d8-7c13-4393-b5d6-036f2fe45126
266 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
267 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
268 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
270 8 a0034eee-1940-4e35-847f-97537a35d05e
272 14 3ee036d8-7c13-4393-b5d6-036f2fe45126
273 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
274 15 c6d09e05-1f25-4164-8860-9f32c5a02df0
275 62 84220f19-9071-4745-9045-3b2f8d3dc128
276 31 1495edf8-2df2-11e9-b210-d663bd873d93
279 303 54df6991-13de-4efc-a1a9-2d5ac1b72ff8
280 302 ec2a91e5-444a-4ca0-87f1-f71ddfaf57eb
281 302 ec2a91e5-444a-4ca0-87f1-f71ddfaf57eb
282 302 ec2a91e5-444a-4ca0-87f1-f71ddfaf57eb
283 34 16238574-0464-11ea-9a9f-362b9e155667
284 36 162386c8-0464-11ea-9a9f-362b9e155667
285 35 162382b8-0464-11ea-9a9f-362b9e155667
287 8 a0034eee-1940-4e35-847f-97537a35d05e
294 73 5021b1a1-e7f6-44b4-ba02-da2f2bcf8718
"""

# Source identifier type uuid, target identifier type uuid.
IDENTIFIER_TYPES = """
58a47054-1359-11df-a1f1-0026b9348838 49af6cdc-7968-4abb-bf46-de10d7f4859f
58a4732e-1359-11df-a1f1-0026b9348838 b4d66522-11fc-45c7-83e3-39a1af21ae0d
f2d6ff1a-8440-4d35-a150-1d4b5a930c5e 05ee9cf4-7242-4a17-b4d4-00f707265c8a
cba702b9-4664-4b43-83f1-9ab473cbd64d f85081e2-b4be-4e48-b3a4-7994b69bb101
91099b3f-69be-4607-a309-bd358d85af46 ac64e5cb-e3e2-4efa-9060-0dd715a843a1
ead42a8f-203e-4b11-a942-df03a460d617 0691f522-dd67-4eeb-92c8-af5083baf338
d8ee3b8c-a8fc-4d6b-af6a-9423be5f8906 d8ee3b8c-a8fc-4d6b-af6a-9423be5f8906
ace5f7c7-c5f4-4e77-a077-5588a682a0d6 5065ae70-0b61-11ea-8d71-362b9e155667
"""

# Source program uuid, target program uuid.  The fifth key starts with a blank and is kept so.
PROGRAMS = [
    ("58a47054-1359-11df-a1f1-0026b9348838", "dfdc6d40-2f2f-463d-ba90-cc97350441a8"),
    ("781d85b0-1359-11df-a1f1-0026b9348838", "dfdc6d40-2f2f-463d-ba90-cc97350441a8"),
    ("c6bf3625-de80-4a88-a913-38273e300a55", "dfdc6d40-2f2f-463d-ba90-cc97350441a8"),
    ("96ba279b-b23b-4e78-aba9-dcbd46a96b7b", "dfdc6d40-2f2f-463d-ba90-cc97350441a8"),
    (" 7843bd0e-2309-44dd-963b-1380789c372c", "dfdc6d40-2f2f-463d-ba90-cc97350441a8"),
    ("3aebf7f4-bb06-40e9-9eb4-0a6ea458bc63", "dfdc6d40-2f2f-463d-ba90-cc97350441a8"),
    ("334c9e98-173f-4454-a8ce-f80b20b7fdf0", "dfdc6d40-2f2f-463d-ba90-cc97350441a8"),
    ("80839137-9711-483f-a239-dfd383d020f6", "b5d9e05f-f5ab-4612-98dd-adb75438ed34"),
    ("01948855-8491-4164-b54f-9b16d174d93e", "c2ecdf11-97cd-432a-a971-cfd9bd296b83"),
    ("d2552058-d7bd-47c6-aed1-480a4308027a", "c2ecdf11-97cd-432a-a971-cfd9bd296b83"),
    ("52aeb285-fb18-455b-893e-3e53ccc77ceb", "c2ecdf11-97cd-432a-a971-cfd9bd296b83"),
    ("781d897a-1359-11df-a1f1-0026b9348838", "c2ecdf11-97cd-432a-a971-cfd9bd296b83"),
    ("91099b3f-69be-4607-a309-bd358d85af46", "9f144a34-3a4a-44a9-8486-6b7af6cc64f6"),
    ("ead42a8f-203e-4b11-a942-df03a460d617", "335517a1-04bc-438b-9843-1ba49fb7fcd9"),
    ("781d8768-1359-11df-a1f1-0026b9348838", "6eda83f0-09d9-11ea-8d71-362b9e155667"),
    ("203571d6-a4f2-4953-9e8b-e1105e2340f5", "24d05d30-0488-11ea-8d71-362b9e155667"),
    ("c19aec66-1a40-4588-9b03-b6be55a8dd1d", "214cad1c-bb62-4d8e-b927-810a046daf62"),
    ("ace5f7c7-c5f4-4e77-a077-5588a682a0d6", "7447305a-18a7-11e9-ab14-d663bd873d93"),
    ("fc15ac01-5381-4854-bf5e-917c907aa77f", "ffee43c4-9ccd-4e55-8a70-93194e7fafc6"),
    ("a8e7c30d-6d2f-401c-bb52-d4433689a36b", "c2ecdf11-97cd-432a-a971-cfd9bd296b83"),
]

# Vital-sign concept uuids, and the measure each vital-sign concept id fills.
VITAL_CONCEPT_UUIDS = [
    "a8a65d5a-1350-11df-a1f1-0026b9348838",
    "a8a65e36-1350-11df-a1f1-0026b9348838",
    "a8a65f12-1350-11df-a1f1-0026b9348838",
    "a8a6f71a-1350-11df-a1f1-0026b9348838",
    "a8a65fee-1350-11df-a1f1-0026b9348838",
    "a8a660ca-1350-11df-a1f1-0026b9348838",
    "a8a6619c-1350-11df-a1f1-0026b9348838",
    "5099d8a8-36c1-4574-a568-9bc49c15c08c",
    "507f48e7-26fc-490b-a521-35d7c5aa8e9f",
    "a8a66354-1350-11df-a1f1-0026b9348838",
    "a89c60c0-1350-11df-a1f1-0026b9348838",
    "9061e5d5-8478-4d16-be44-bfec05b6705a",
    "a89c6188-1350-11df-a1f1-0026b9348838",
]
VITALS = {
    9816: "height_age_zscore", 8238: "weight_height_zscore", 8239: "bmi_age_zscore", 1342: "bmi", 1343: "muac_mm",
    5085: "systolic_bp", 5086: "diastolic_bp", 5087: "pulse", 5088: "temperature", 5092: "spo2", 5242: "rr",
    5089: "weight", 5090: "height",
}

# Enrolment encounter types, initial encounter types and the enrolment concepts.
ENROLLMENT_ENCOUNTER_TYPES = [1, 3, 24, 32, 105, 137, 135, 136, 265, 266]
INITIAL_ENCOUNTER_TYPES = [1, 3, 105, 265, 266, 32]
ENROLLMENT_CONCEPTS = [
    8287, 1224, 1724, 10792, 6750, 6749, 1915, 10747, 10748, 7013, 1499, 9203, 6748, 5356, 1633, 2155, 966, 1088,
    2056, 5090, 1343, 5629, 1174, 10653, 10873, 10872, 10741,
]
ENROLLMENT_CATEGORY = "HIV Enrollment"

# Regimen concept, reasons for a regimen change, initial-visit concept and its target code.
REGIMEN_CONCEPT = 1088
REGIMEN_CHANGE_CONCEPTS = [1252, 1262, 1266, 1269]
INITIAL_OBS_CONCEPT = 1724
INITIAL_OBS_TARGET_UUID = "423c034e-14ac-4243-ae75-80d1daddce55"

# Patient type codes and entry-point codes.
NEW_PATIENT_FORM = 15
PATIENT_TYPE_NEW = 164144
PATIENT_TYPE_TRANSFER_IN = 160563
PATIENT_TYPE_TRANSIT = 164931
TRANSFER_IN_CONCEPT = 10194
ENTRY_POINT_CONCEPT = 2051
FIRST_CARE_DATE_CONCEPT = 7013
ENTRY_POINTS = {2047: 160539, 2240: 162050, 2177: 162050, 1965: 160542, 1776: 160536}

# Constants of the receiving system's documents.
DOCUMENT_LOCATION = "c55535b8-b9f2-4a97-8c6c-4ea9496256df"
GENERATED_IDENTIFIER_TYPE = "dfacd928-0370-4315-99d7-6ec1c9f7ae76"
DASH_FREE_IDENTIFIER_TYPE = "f2d6ff1a-8440-4d35-a150-1d4b5a930c5e"
USER_ROLE = "b1ad7622-9548-4c0e-a137-17ea4a2d892a"
VISIT_TYPE = "3371a4d4-f66f-4454-a86d-92c7b3da990c"
BUNDLE_VISIT_TYPE = "9865c08a-97a4-4571-b873-dd422583b3a7"
BUNDLE_ENCOUNTER_TYPE = "465a92f2-baf8-42e9-9612-53064be868e8"
BUNDLE_FORM = "22c68f86-bbf0-49ba-b2d1-23fa7ccf0259"
ENCOUNTER_ROLE = "a0b03050-c99b-11e0-9572-0800200c9a66"
CARE_SETTING = "OUTPATIENT"
OPEN_ENDED_PROGRAM_IDS = [1, 3, 9, 20]

# Texts and codes that stand for a missing or refused row.
PATIENT_NOT_MIGRATED = "Client Not Migrated"
PATIENT_MISSING = "Patient is Missing"
NOT_FOUND = "Not Found"
UUID_NOT_FOUND = "UUID not found"
CREATED = "201"
REJECTED = "400"
