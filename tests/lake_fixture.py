"""A dozen hand-written rows per raw source with every defect the rules know."""

import json
import os
from datetime import datetime, timedelta

from farelake import config as C

AS_OF = datetime(2026, 9, 1)
SETTINGS = C.Settings(as_of=AS_OF, salt="test-salt")
CUT = datetime(2026, 7, 1)

TM_STATIONS = [
    "estacion_id,nombre,linea,zona,lat,lon",
    "TM-L1-01,Centro,L1,Zona 1,14.6,-90.5",
    "TM-L1-02,Roosevelt,L1,Mixco,14.61,-90.55",
    "TM-L2-01,Sur,L2,Zona 12,14.58,-90.54",
]
TU_STOPS = [
    "cod_parada,descripcion,ruta,sector",
    "R-101-1,Parada A,R-101,Z10",
    "R-101-2,Parada B,R-101,VILLA NUEVA",
    "R-102-1,Parada C,R-102,SAN MIGUEL PETAPA",
]
MR_STATIONS = ["id_estacion,nombre_estacion,zona_nombre,km", "1,Norte,Zona 17,0.0", "2,Atanasio,Zona 12,5.5"]
AM_STATIONS = ["station_code,station_name,axis,district", "AM-1,Cumbre,E1,Mixco", "AM-2,Valle,E1,Zona 7"]

_TM = [  # id, card, station, local time
    (1, 7, "TM-L1-01", "2026-06-03 00:00:00"),  # exactly t - 28 d
    (2, 7, "TM-L1-02", "2026-06-10 07:30:00"),
    (3, 7, "TM-L1-01", "2026-06-20 18:10:00"),
    (4, 8, "TM-L1-01", "2026-06-15 08:00:00"),
    (5, 8, "TM-L1-01", "2026-06-15 12:00:00"),
    (6, 9, "TM-L2-01", "2026-06-16 09:00:00"),
    (7, 9, "TM-L2-01", "2026-06-18 09:00:00"),
    (8, 7, "TM-L1-01", "2026-07-31 00:00:00"),  # exactly t + 30 d
    (9, 8, "TM-L1-01", "2026-07-01 00:00:00"),  # exactly t
    (10, 12, "TM-L1-01", "2026-08-30 10:00:00"),
    (11, 13, "TM-L1-01", "2027-09-01 10:00:00"),  # clock 400 days ahead
    (12, 7, "TM-UNKNOWN", "2026-06-21 06:00:00"),  # station missing in the catalogue
]


def tm_rows():
    rows = [
        f"{i},TC-{n:08d},{st},{st[3:5]},{ts},1.0,{'TRANSBORDO' if i == 3 else 'ENTRADA'}" for i, n, st, ts in _TM
    ]
    return [
        "validacion_id,tarjeta,estacion_id,linea,fecha_hora,tarifa,tipo",
        *rows[:4],
        rows[3],  # identical turnstile read of id 4
        rows[3],
        *rows[4:],
        "14,TC-00000014,TM-L1-01,L1,not a time,1.0,ENTRADA",
    ]


TU = [
    "fecha,hora,num_tarjeta,cod_parada,ruta,monto_centavos,cod_estado",
    "05/06/2026,06:10:00,0000000007,R-101-1,R-101,110,1",
    "06/06/2026,06:10:00,0000000007,R-101-2,R-101,110,2",
    "06/06/2026,06:10:00,0000000007,R-101-2,R-101,110,2",  # identical row: two transactions
    "13/06/2026,17:00:00,0000000010,R-102-1,R-102,110,3",
    "14/06/2026,17:00:00,0000000010,R-102-1,R-102,110,1",
    "14/06/2026,17:05:00,0000000010,,R-102,110,1",  # no stop
    "14/06/2027,17:05:00,0000000010,R-101-1,R-101,110,1",  # future
    "15/06/2027,17:05:00,0000000010,,R-101,110,7",  # no stop, future and rejected
    "15/06/2026,17:05:00,0000000010,R-101-1,R-101,110,7",  # rejected
    "15/06/2026,17:06:00,0000000010,R-101-1,R-101,110,9",  # rejected
    "02/07/2026,10:00:00,0000000010,R-101-1,R-101,110,1",
]


def _trip(i, n, a, t0, b=None, t1=None, fare=3.5):
    dur = None if t1 is None else int((datetime.fromisoformat(t1) - datetime.fromisoformat(t0)).total_seconds())
    return json.dumps(
        {
            "trip_id": i,
            "card": f"MR{n:07d}",
            "entry": {"station": a, "ts": t0},
            "exit": None if b is None else {"station": b, "ts": t1},
            "fare_gtq": fare,
            "duration_s": dur,
        }
    )


MR = [
    _trip(1, 7, 1, "2026-06-11T07:00:00", 2, "2026-06-11T07:20:00"),
    _trip(2, 11, 2, "2026-06-12T09:00:00", 1, "2026-06-12T09:30:00"),
    _trip(3, 11, 2, "2026-06-30T23:50:00", 1, "2026-07-01T00:10:00"),  # closed after the cut
    _trip(4, 11, 1, "2026-06-14T09:00:00"),  # never left
    _trip(5, 11, 1, "2026-06-19T09:00:00", 1, "2026-06-19T09:05:00"),
    '{"trip_id": 6, "card": "MR00',  # broken line
]
AM = [
    "boarding_id,user_hash,station_code,axis,timestamp_utc,cabin_number,fare",
    "1,aaaaaaaaaaaa,AM-1,E1,2026-06-12T02:00:00Z,4,5.0",  # previous local day, 20:00
    "2,aaaaaaaaaaaa,AM-2,E1,2026-06-13T14:00:00Z,5,5.0",
    "3,bbbbbbbbbbbb,AM-1,E1,2026-07-01T05:59:59Z,4,5.0",  # still June locally
    "4,bbbbbbbbbbbb,AM-1,E1,2026-06-20T12:00:00Z,4,5.0",
    "5,cccccccccccc,AM-1,E1,2027-06-20T12:00:00Z,4,5.0",  # future
]
CDC = [
    "seq,commit_ts,op,tarjeta,perfil,zona_residencia,estado",
    "1,2026-05-01T10:00:00,INSERT,TC-00000007,trabajador,Zona 1,ACTIVA",
    "2,2026-05-02T10:00:00,INSERT,TC-00000009,general,Zona 12,ACTIVA",
    "3,2026-05-20T10:00:00,DELETE,TC-00000009,,,",  # before the cut: out
    "4,2026-05-03T10:00:00,INSERT,0000000010,estudiante,Mixco,ACTIVA",
    "5,2026-07-05T10:00:00,DELETE,0000000010,,,",  # after the cut: in
    "6,2026-06-01T10:00:00,UPDATE,MR0000011,general,Zona 7,ACTIVA",  # update without insert
    "7,2026-06-01T09:00:00,UPDATE,TC-00000007,adulto_mayor,,ACTIVA",
    "8,2026-06-02T09:00:00,INSERT,SIN-TARJETA,general,Zona 2,ACTIVA",
    "9,2026-08-02T09:00:00,DELETE,TC-00000012,,,",
    "not a number,2026-08-01T09:00:00,INSERT,TC-00000012,general,Zona 3,ACTIVA",
    "10,2026-08-01T09:00:00,INSERT,TC-00000012,general,Zona 3,ACTIVA",  # back, commit time before seq 9's
]


def write(folder):
    os.makedirs(folder, exist_ok=True)
    files = {
        "tm_estaciones.csv": TM_STATIONS,
        "tu_paradas.csv": TU_STOPS,
        "mr_estaciones.csv": MR_STATIONS,
        "am_estaciones.csv": AM_STATIONS,
        "transmetro_validaciones.csv": tm_rows(),
        "transurbano_transacciones.csv": TU,
        "metroriel_viajes.jsonl": MR,
        "aerometro_boardings.csv": AM,
        "cdc_padron_usuarios.csv": CDC,
    }
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    return {
        "tm_estaciones": 3, "tu_paradas": 3, "mr_estaciones": 2, "am_estaciones": 2,
        "mr_viajes": len(MR), "tm_validaciones": len(tm_rows()) - 1, "am_boardings": len(AM) - 1,
        "tu_transacciones": len(TU) - 1, "cdc_padron_usuarios": len(CDC) - 1,
    }


def local(text, hours=-6):
    return datetime.fromisoformat(text) + timedelta(hours=hours)
