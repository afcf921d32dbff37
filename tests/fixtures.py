"""FIXTURES.md inputs FX1 / FX2 as Python values."""

FX1 = [
    ('{"first_name":"  Ines ","last_name":"Okafor","gender":"FEMALE","postcode":"4051",'
     '"email":" Ines.Okafor@Mail.test ","username":"IOkafor","dob":"1979-11-30","phone":" +41 61 000 "}', 1),
    ('{"name":{"first":"Teodor","last":"Brandt"},"gender":"male","location":{"postcode":9020},'
     '"email":"teo@mail.test","login":{"username":"teo.b"},"dob":{"date":"2001-06-09T23:00:00.000Z"},'
     '"phone":"07-77","nat":"AT"}', 1),
    ('{"first_name":"Ines","last_name":"Diallo","gender":"female","postcode":"4051",'
     '"email":"ines.okafor@mail.test","username":"iokafor ","dob":"1979-11-30","phone":"111"}', 2),
    ('{"first_name":"Ines","last_name":"Silva","gender":"female","postcode":"4051",'
     '"email":"ines.okafor@mail.test","username":"iokafor","dob":"1979-11-30","phone":"222"}', 2),
    ('{"last_name":"Lost","username":"lost"}', 3),
    ("{broken", 3),
    ('{"first_name":null,"last_name":"Mono","email":"mono@mail.test","username":"mono","dob":"unknown"}', 3),
    ('{"username":"agedob","email":"agedob@mail.test","dob":{"age":41},"gender":"unknown"}', 4),
    ('{"first_name":"Kofi","last_name":"Z","gender":"male","email":"KOFI@mail.test","username":"kofi",'
     '"dob":"1984-02-29"}', 4),
]

FX2 = [
    ('{"before":null,"after":{"id":11,"name":"Mara Prior","email":"prior@mail.test",'
     '"department":"Finance"},"op":"r","ts_ms":1767225600000}', 1),
    ('{"before":null,"after":{"id":12,"name":" Kofi Zed ","email":"Kofi@Mail.test","department":"Support "},'
     '"op":"r","ts_ms":1767225600000}', 1),
    ('{"before":null,"after":{"id":14,"name":"Ines Okafor","email":"ines.okafor@mail.test",'
     '"department":"Finance"},"op":"c","ts_ms":1767225601000}', 2),
    ('{"before":{"id":14},"after":{"id":14,"name":"Ines Okafor","email":"ines.okafor@mail.test",'
     '"department":"Research"},"op":"u","ts_ms":1767225602500}', 2),
    ('{"before":{"id":11},"after":null,"op":"d","ts_ms":1767225603000}', 3),
    (None, 3),
    ("no envelope here", 3),
    ('{"before":null,"after":{"id":"19","name":"Text Key","email":"text@mail.test"},"op":"c",'
     '"ts_ms":1767225603500}', 3),
    ('{"before":null,"after":{"id":15,"name":null,"email":"noname@mail.test","department":"Lab"},"op":"c",'
     '"ts_ms":1767225604000}', 4),
    ('{"before":null,"after":{"id":14,"name":"Ines Stale","email":"ines.okafor@mail.test",'
     '"department":"Stale"},"op":"u","ts_ms":1767225601500}', 5),
]

LATE_UPDATE_AFTER_DELETE = (
    '{"before":{"id":11},"after":{"id":11,"name":"Mara Again","email":"prior@mail.test",'
    '"department":"Finance"},"op":"u","ts_ms":1767225600500}', 6)
