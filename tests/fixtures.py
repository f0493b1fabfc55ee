"""Inline test inputs.

Fixed values: the rows below are the reference's own test inputs (9 sales rows, 10 prepared
rows), kept verbatim so the golden outputs in FIXTURES.md apply.
"""

import io

import pandas as pd

TRANSACTIONS_CSV = """prix,id_ville,ville,type_batiment,vefa,n_pieces,surface_habitable,latitude,longitude,mois_transaction,annee_transaction,prix_m2,prix_m2_moyen,nb_transactions_mois,en_dessous_du_marche,nom_departement,nom_region
98000.0,53,BOURG-EN-BRESSE,Appartement,0,3,70,46.204952,5.225964,1,2018,1400.000000,1229.764459,17,0,Ain,Auvergne-Rhône-Alpes
225000.0,143,DIVONNE-LES-BAINS,Appartement,0,2,56,46.355345,6.137488,1,2018,4017.857143,4512.419826,9,1,Ain,Auvergne-Rhône-Alpes
67000.0,53,BOURG-EN-BRESSE,Appartement,0,1,45,46.201122,5.237210,1,2018,1488.888889,1229.764459,17,0,Ain,Auvergne-Rhône-Alpes
110000.0,53,BOURG-EN-BRESSE,Appartement,0,3,70,46.204952,5.225964,2,2018,1571.428571,1229.764459,12,0,Ain,Auvergne-Rhône-Alpes
220000.0,143,DIVONNE-LES-BAINS,Appartement,0,2,56,46.355345,6.137488,2,2018,3928.571429,4512.419826,8,1,Ain,Auvergne-Rhône-Alpes
65000.0,53,BOURG-EN-BRESSE,Appartement,0,1,45,46.201122,5.237210,2,2018,1444.444444,1229.764459,15,0,Ain,Auvergne-Rhône-Alpes
100000.0,143,DIVONNE-LES-BAINS,Appartement,0,2,56,46.355345,6.137488,3,2018,3571.428571,4512.419826,11,1,Ain,Auvergne-Rhône-Alpes
195000.0,53,BOURG-EN-BRESSE,Appartement,0,3,70,46.204952,5.225964,3,2018,2785.714286,1229.764459,14,0,Ain,Auvergne-Rhône-Alpes
69000.0,143,DIVONNE-LES-BAINS,Appartement,0,1,45,46.355345,6.137488,3,2018,1533.333333,4512.419826,10,1,Ain,Auvergne-Rhône-Alpes
"""


def transactions_pdf() -> pd.DataFrame:
    return pd.read_csv(io.StringIO(TRANSACTIONS_CSV))


PREPARED = {
    "prix": [190000.0, 90000.0, 65000.0, 250000.0, 150000.0, 300000.0, 120000.0, 200000.0, 175000.0, 220000.0],
    "type_batiment": ["Appartement", "Appartement", "Appartement", "Maison", "Maison",
                      "Appartement", "Maison", "Appartement", "Maison", "Appartement"],
    "vefa": [0, 0, 0, 1, 1, 0, 0, 0, 1, 0],
    "surface_habitable": [139, 60, 87, 120, 95, 130, 80, 100, 110, 105],
    "latitude": [46.1983, 46.1993, 46.2044, 46.2087, 46.2078, 46.2015, 46.2154, 46.2100, 46.2135, 46.2223],
    "longitude": [5.2287, 5.2183, 5.2351, 5.2301, 5.2400, 5.2175, 5.2134, 5.2204, 5.2356, 5.2220],
    "mois_transaction": [2, 2, 2, 3, 3, 2, 1, 1, 3, 3],
    "annee_transaction": [2018, 2018, 2018, 2019, 2019, 2018, 2020, 2020, 2020, 2021],
    "en_dessous_du_marche": [0, 0, 1, 0, 1, 0, 0, 1, 0, 1],
    "nom_region": ["Auvergne-Rhône-Alpes", "Nouvelle-Aquitaine", "Occitanie",
                   "Provence-Alpes-Côte d'Azur", "Provence-Alpes-Côte d'Azur",
                   "Nouvelle-Aquitaine", "Île-de-France", "Île-de-France",
                   "Provence-Alpes-Côte d'Azur", "Auvergne-Rhône-Alpes"],
    "prix_m2_moyen_mois_precedent": [1229.76, 1229.76, 1229.76, 1350.50, 1350.50,
                                     1229.76, 1400.20, 1400.20, 1350.50, 1300.80],
    "nb_transactions_mois_precedent": [17, 17, 17, 20, 20, 17, 25, 25, 20, 23],
    "ville_demandee": [1, 1, 1, 0, 0, 1, 1, 0, 1, 1],
}


def prepared_pdf() -> pd.DataFrame:
    df = pd.DataFrame(PREPARED)
    df.insert(0, "id_transaction", [f"t{i:02d}" for i in range(len(df))])
    return df
